"""License scans against loops, and WARC archives there and back."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import licenses, warc

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def _terms(text):
    cut = re.split(r"[^a-z0-9.\u0080-\U0010ffff]+", (text or "").lower())
    return [t for t in (re.sub(r"^\.+|\.+$", "", t) for t in cut) if t]


def _plain(files):
    """path -> (own, score, line, is_file, license, from), by loops."""
    df = Counter(t for _, text in files for t in set(_terms(text)))

    def vector(text):
        return {t: n * (math.log((1 + len(files)) / (1 + df[t])) + 1) for t, n in Counter(_terms(text)).items()}

    def best(text, cut):
        v = vector(text)
        size = math.sqrt(sum(w * w for w in v.values()))
        scores = []
        for name, body in licenses.TEMPLATES:
            t = vector(body)
            dot = sum(w * t.get(k, 0) for k, w in v.items())
            if size:
                scores.append((-round(dot / size / math.sqrt(sum(w * w for w in t.values())), 9), name))
        return min(scores) if scores and -min(scores)[0] >= cut else None

    own = {}
    for path, text in files:
        lines = [(*b, i) for i, line in enumerate((text or "").split("\n")) if (b := best(line, 0.8))]
        head, whole = own.get(path or "", (None, None))
        heads = [x for x in (head, min(lines, default=None)) if x]
        wholes = [x for x in (whole, best(text, 0.5)) if x]
        own[path or ""] = (min(heads, default=None), min(wholes, default=None))

    def folder(path):
        return re.sub(r"/*[^/]*$", "", path)

    holders = {}
    for path, (_, whole) in own.items():
        if whole:
            d = folder(path)
            holders[d] = min(holders.get(d, (0, "~", "")), (*whole, path))
    out = {}
    for path, (head, whole) in own.items():
        name, score = (whole or head or (None, None))[1], (whole or head or (None,))[0]
        above, source = folder(path), None
        while name is None and source is None:
            if above in holders:
                source = above
            elif not above:
                break
            else:
                above = above.rpartition("/")[0]
        out[path] = (
            name, None if score is None else round(-score, 6), head and head[2], whole is not None,
            name or (holders[source][1] if source is not None else None), source,
        )
    return out


def test_licenses_equal_loops(spark):
    files = [
        ("a/LICENSE", MIT), ("a/b/x.txt", "no word of it here"), ("a/b/c/COPYING", GPL), ("a/b/c/d/e.txt", "plain\ntext"),
        ("a/b/c/own.txt", "first line\n  LICENSED under the Apache License, Version 2.0\nmore"), ("f.txt", "nothing"),
        ("a/null.txt", None), ("a/empty.txt", ""), (None, "license"), ("g/two.txt", MIT + "\n" + GPL), ("a/LICENSE", MIT),
        ("g/near.txt", "license license the the of this and that and many other words of no weight at all"),
        ("g/LICENSE", "Licensed under CC BY 4.0."), ("g/LICENSE-B", "Licensed under CC BY-NC 4.0."), ("ab/c.txt", "x"),
        ("g/long.txt", "word " * 60_000 + "\n" + MIT), ("g/ß.txt", "KKMIT License ümit"), ("/root.txt", "r"),
    ]
    rows = [(p, t, "mine") for p, t in files]
    out = licenses.scan(spark.createDataFrame(rows, "path string, text string, license string")).collect()
    want = _plain(files)
    assert len(out) == len(files)
    for r in out:
        got = (r["own_license"], r["own_score"], r["own_line"], r["is_license_file"], r["license"], r["inherited_from"])
        assert got == want[r["path"] or ""], r["path"]
    found = {r["path"]: r["license"] for r in out}
    assert found["a/b/x.txt"] == "MIT" and found["a/b/c/d/e.txt"] == "GPL-3.0" and found["f.txt"] is None
    assert found["a/b/c/own.txt"] == "Apache-2.0" and found["g/long.txt"] == "MIT"


def test_full_texts_and_wrapped_headers(spark):
    full = {n: b for n, b in licenses.FULL_TEXTS}
    gpl = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""
    wrapped = "\n".join("// " + w for w in re.findall(r".{1,60}(?:\s|$)", dict(licenses.NOTICES)["Apache-2.0"]))
    code = "\n".join(f"value{i} = reader{i}.open(name{i})" for i in range(40))
    files = [
        ("m/LICENSE", full["MIT"].replace("MIT License", "MIT License\n\nCopyright (c) 2024 Jane Doe\n")), ("m/x/y.txt", code),
        ("g.c", f"/*\n * Reader of names\n *\n{gpl}\n */\n{code}"), ("a.cc", f"#!/bin/x\n{wrapped}\n{code}"),
        ("j.py", f"# Copyright 2024 Jane Doe. Released under the MIT License.\n{code}"),
        ("s.rs", f"// SPDX-License-Identifier: Apache-2.0\n{code}"), ("b/LICENSE.txt", "Copyright 2024 Jane Doe\n" + full["BSD-3-Clause"]),
        ("n.txt", code), (None, None),
    ]
    out = licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()
    got = {r["path"]: (r["license"], r["is_license_file"], r["inherited_from"]) for r in out}
    assert got["m/LICENSE"] == ("MIT", True, None) and got["m/x/y.txt"] == ("MIT", False, "m")
    assert got["b/LICENSE.txt"] == ("BSD-3-Clause", True, None)
    assert {p: got[p][0] for p in ("g.c", "a.cc", "j.py", "s.rs", "n.txt")} == {
        "g.c": "GPL-3.0", "a.cc": "Apache-2.0", "j.py": "MIT", "s.rs": "Apache-2.0", "n.txt": None}
    assert {r["path"]: r["own_line"] for r in out}["g.c"] == 3


PUBLIC = Path("/usr/share/common-licenses")
NAMED = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
         "MPL-2.0": "MPL-2.0", "MPL-1.1": "MPL-1.1", "CC0-1.0": "CC0-1.0"}


@pytest.mark.skipif(not PUBLIC.exists(), reason="no license texts on this machine")
@pytest.mark.parametrize("others", [20, 400])
def test_published_texts_are_license_files(spark, others):
    words = ["the", "of", "and", "in", "that", "is", "render", "total", "price", "anander", "oftion", "thing"]
    draw = random.Random(4)
    prose = [(f"p/{i}.txt", " ".join(draw.choice(words) for _ in range(80)) + f" w{i}.\nrow {i}") for i in range(others)]
    files = [(f"{n}/LICENSE", (PUBLIC / n).read_text()) for n in NAMED] + [(f"{n}/src/a.py", "import os") for n in NAMED]
    out = licenses.scan(spark.createDataFrame(files + prose, "path string, text string")).collect()
    got = {r["path"]: (r["license"], r["is_license_file"], r["inherited_from"]) for r in out}
    for n, name in NAMED.items():
        assert got[f"{n}/LICENSE"] == (name, True, None) and got[f"{n}/src/a.py"] == (name, False, n)
    assert all(got[p] == (None, False, None) for p, _ in prose)


def test_a_notice_of_many_short_lines(spark):
    body = max((b for n, b in licenses.NOTICES if n == "Apache-2.0"), key=len).split()
    lines = "\n".join("# " + " ".join(body[i : i + 2]) for i in range(0, len(body), 2))
    assert lines.count("\n") > 2 * licenses.LONGEST
    code = "\n".join(f"value{i} = reader{i}.open(name{i})" for i in range(900))
    files = [("a.py", f"import os\n\n\n\n{lines}\n\n\n\n{code}"), ("b.py", code)]
    got = {r["path"]: r for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a.py"]["license"] == "Apache-2.0" and got["a.py"]["own_score"] > 0.99 and got["b.py"]["license"] is None


def test_clashing_names_pass_through(spark):
    names = ["header", "whole", "from_above", "folder", "holder", "version", "best", "own_path", "terms"]
    files = spark.createDataFrame([("a/LICENSE", MIT), ("a/b.txt", "x")], "path string, text string")
    out = licenses.scan(files.selectExpr("*", *[f"'{n}!' AS {n}" for n in names], "'q' AS license")).collect()
    assert [r["license"] for r in out] == ["MIT", "MIT"]
    assert all(r[n] == f"{n}!" for r in out for n in names)


def test_no_python_in_the_license_plan(spark):
    rows = spark.createDataFrame([("a/LICENSE", MIT)], "path string, text string").cache()
    plan = licenses.scan(rows)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_needed_terms_bound_the_cosine():
    vectors = [{"a": 0.8, "b": 0.6}, {"c": 1.0}]
    assert licenses._needed(vectors, 0.9) == ["a", "c"] and licenses._needed(vectors, 0.5) == ["a", "b", "c"]


def test_licenses_of_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0


# -- WARC -----------------------------------------------------------------------
TRICKY = "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "\r\n\r\n" * 3 + "ü" * 80


def _captures(spark, path):
    return warc.assemble(warc.read(spark, path)).collect()


@pytest.fixture
def site():
    long = "<p>same</p>" * 20
    return [
        (5, "https://h.example/a?b#c", long), (3, "https://h.example/b", long), (9, None, long), (1, "no url", "short"),
        (2, "https://h.example", "short"), (4, "https://h.example/x\r\ny", TRICKY), (6, "https://h.example/n", None),
        (7, "https://h.example/e", ""), (8, "https://h.example/8", TRICKY), (None, "https://h.example/null", long),
        (3, "https://h.example/b", long), (10, "https://h.example/long", "z" * 3_000_000),
    ]


@pytest.mark.parametrize("file_bytes", [32 << 20, 20_000])
def test_archives_there_and_back(spark, tmp_path, site, file_bytes):
    path = str(tmp_path / "archive")
    rows = spark.createDataFrame([(*r, "x") for r in site], "page_id long, url string, html string, record_id string")
    warc.write(rows, path, file_bytes=file_bytes)
    out = _captures(spark, path)
    assert len(out) == len(site)
    by_record = {r["record_id"]: r for r in out}
    assert len(by_record) == len(site)
    first = {}
    for page, _, html in site:
        first[html] = min((p for p in (first.get(html), page) if p is not None), default=None)
    seen = Counter()
    for r in out:
        fields, c = r["metadata"]["fields"], r["capture"]
        page = int(fields["page-id"]) if "page-id" in fields else None
        url, html = next((u, h) for p, u, h in site if p == page)
        body = (html or "").encode()
        assert (c["payload_bytes"], c["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert c["target_uri"] == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
        if c["type"] == "response":
            assert bytes(c["payload"]) == body and c["refers_to"] is None
            assert len(body) < 100 or page == first[html]
            seen[html] += 1
        else:
            assert len(body) >= 100 and c["payload"] is None
            source = by_record[c["refers_to"]]
            assert source["capture"]["type"] == "response" and int(source["metadata"]["fields"]["page-id"]) == first[html]
        assert r["request"]["fields"][":request"].startswith("GET /") and "host" in r["request"]["fields"]
    assert all(seen[h] == 1 for h in seen if h and len(h) >= 100)


def test_foreign_archive(spark, tmp_path):
    def record(kind, number, block, **more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{number}>", *[f"{k.replace('_', '-')}: {v}" for k, v in more.items()]]
        return ("WARC/1.0\r\n" + "\r\n".join(head) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    body = b"\xff\xfe\r\n\r\nWARC/1.0\r\n"
    parts = [
        record("warcinfo", 1, b"software: x\r\n"),
        record("metadata", 4, b"via: y\r\n", WARC_Concurrent_To="<urn:2>"),
        record("response", 2, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body),
        record("request", 6, b"GET /z HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<urn:2>"),
        record("request", 5, b"GET /y HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<urn:2>"),
        record("response", 7, b"HTTP/1.1 404 Gone\r\n\r\n"),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[:4]))
    (tmp_path / "in" / "b.warc").write_bytes(b"".join(parts[4:]))
    out = {r["record_id"]: r for r in _captures(spark, str(tmp_path / "in"))}
    assert set(out) == {"<urn:2>", "<urn:7>"}
    assert bytes(out["<urn:2>"]["capture"]["payload"]) == body and out["<urn:2>"]["request"]["record_id"] == "<urn:5>"
    assert out["<urn:2>"]["metadata"]["fields"] == {"via": "y"}
    assert out["<urn:7>"]["request"] is None and out["<urn:7>"]["capture"]["payload_bytes"] == 0


def test_broken_archive_is_an_error(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="ends early"):
        _captures(spark, str(tmp_path))


def test_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).filter(F.col("type") == "response").count() == 0
