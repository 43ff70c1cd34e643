"""The pipeline against a plain version, and the queries against their SQL."""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from oracle_check import compare, duck
from shelfwatch.llm import quality, secrets
from test_scans import _marked
from test_simhash import _groups, _print
from test_tokens_and_packing import _check_packing

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duck(FOLDER)


def test_every_query_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", [n for n in sorted(oracle_sql()) if n.startswith("op") and n[2].isdigit()])
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER)
    assert problem is None


def test_pipeline_equals_a_plain_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    model = quality.fit(docs, labels)
    good = sorted(
        (r["doc_id"], r["text"]) for r in quality.score(docs, model).filter("predicted = 1").collect()
    )
    heads, first = _groups([_print(t) for _, t in good]), {}
    for (doc, text), h in zip(good, heads):
        first.setdefault(h, (doc, text))
    distinct = sorted(first.values())
    clean = [row for row, (_, hit, _) in zip(distinct, _marked([t for _, t in distinct], items)) if not hit]
    markov = secrets.fit(spark.createDataFrame(clean, "doc_id long, text string"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for doc, text in clean:
        out, last = "", 0
        for a, _, b in secrets.all_spans(text.encode(), markov):
            if b > last:
                out, last = out + text[last : max(a, last)] + ("[SECRET]" if a >= last else ""), b
        ids = tokenizer.encode(out + text[last:], add_special_tokens=False).ids + [0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want.add((doc, n, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = cp.run(spark, FOLDER).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want) and _check_packing(rows, 2048) >= 1
    assert 0 < len(clean) < len(distinct) <= len(good) < docs.count()


def test_stages_keep_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    text = "plain words of a good enough length to be told from junk by anything that counts them"
    rows = [(1, text + " token=abcdefabcdef0123", "en", "s", 110, "x"), (2, None, None, None, None, None), (3, "", "", "", 0, "")]
    docs = spark.createDataFrame(rows, schema)
    out = cp.redact_secrets(spark, docs, FOLDER)
    assert out.columns == cp.DOCUMENT
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    shorter = len("token=abcdefabcdef0123") - len("[SECRET]")
    assert got == {1: (text + " [SECRET]", 110 - shorter), 2: (None, None), 3: ("", 0)}
    assert {r["doc_id"] for r in cp.keep_distinct(spark, docs, FOLDER).collect()} == {1, 2}
    assert cp.drop_benchmark(spark, docs, FOLDER).columns == cp.DOCUMENT
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
