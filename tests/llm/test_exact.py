import hashlib
import re
from collections import defaultdict

import pytest

from stationtide.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def check(rows, result):
    """Everything that does not depend on which of fully equal rows is kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(normal(t).encode()).hexdigest()].append(i)
    want = sorted(((i, min((x for x in groups[h] if x is not None), default=None) if len(groups[h]) > 1 else i, len(groups[h]), h)
                   for h, ids in groups.items() for i in ids), key=str)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in result), key=str) == want
    kept = [r for r in result if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted(groups) and all(r.doc_id == r.keep_id for r in kept)


ROWS = [(i, f"text {i % 70}\t\n  of some kind {i % 70}") for i in range(200)] + [(1000 + i, "one text " * 20) for i in range(150)]
ROWS += [(5, "text 5 of some kind 5"), (2000, None), (2001, ""), (2002, " "), (2003, "\t\r\n"), (2004, " "), (None, "lone"), (None, "both"), (None, "both"),
         (7, "again"), (7, "again"), (7, "again"), (None, "again"), (2005, "é" * 300_000), (2006, "é" * 300_000), (2007, "Case"), (2008, "case")]


@pytest.mark.parametrize("blocks", [exact.BROADCAST_BLOCKS, 0])
def test_equals_brute_force(frame, monkeypatch, blocks):
    monkeypatch.setattr(exact, "BROADCAST_BLOCKS", blocks)
    docs = frame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS _code", "2 AS _n", "3 AS keep_id", "4 AS kept")
    check(ROWS, exact.mark_repeats(docs).collect())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], exact.mark_repeats(docs).collect())


def test_rows_that_stay(frame):
    docs = frame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS _code", "2 AS `my col`", "doc_id AS _id")
    got = exact.keep_first(docs)
    assert got.columns == docs.columns
    marked = [(r.doc_id, r.text_sha256) for r in exact.mark_repeats(docs).collect() if r.kept]
    assert sorted(((r.doc_id, hashlib.sha256(normal(r.text).encode()).hexdigest()) for r in got.collect()), key=str) == sorted(marked, key=str)


def test_lone_rows_are_not_grouped(frame):
    rows = [(i, f"{i} text") for i in range(3000)] + [(i, "copy") for i in range(3000, 3040)]
    found = exact.Repeats(frame(rows, "doc_id long, text string"))
    maybe = {r.doc_id for r in found.rows.filter("_maybe").collect()}
    assert set(range(3000, 3040)) <= maybe and len(maybe) < 40 + 0.03 * 3000
    assert [tuple(r) for r in found.groups.select("_n", "_keep").collect()] == [(40, 3000)]


def test_empty_table(frame):
    docs = frame([], "doc_id long, text string")
    assert exact.mark_repeats(docs).count() == 0 and exact.keep_first(docs).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for out in (exact.mark_repeats(docs), exact.keep_first(docs)):
        plan = out._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
