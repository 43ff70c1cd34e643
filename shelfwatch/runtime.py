"""Session settings and lineage cuts shared by the iterative jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfwatch", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs are written for.

    Nothing in the library depends on them: a caller may pass any session.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # The JVM never compiles a method beyond 8000 bytes; smaller pieces run faster.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


# Folders made for local sessions without a checkpoint folder, by application.
_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process (``local`` or
    ``local[...]``, as in tests) may leave it unset and gets a temporary folder;
    any other session must name a folder that every executor can reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="shelfwatch-")
    return _LOCAL_SCRATCH[app]


class Scratch:
    """The intermediate tables of one job, in a folder of its own.

    Tables are Parquet in the shared folder, so a lost executor never replays the
    rounds before, the planner sees true sizes, and columns stay prunable. A job
    drops what a later round has replaced; the last tables back the result.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{job}-{uuid.uuid4().hex}"
        self._tables = 0

    def path(self, label: str) -> str:
        self._tables += 1
        return f"{self.root}/{self._tables:03d}-{label}"

    def write(self, df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
        """Write *df* and read it back."""
        path = self.path(label)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of :meth:`write` that nothing reads any more."""
        for table in tables:
            remove_folder(self.spark, table._scratch_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the job's own through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write *df* as a table in a scratch folder of its own and read it back."""
    return Scratch(df.sparkSession, label).write(df, label, partition_by)
