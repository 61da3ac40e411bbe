import zlib

import pytest

from stationtide.llm import curve

COLUMNS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("bits, dimensions", [(1, 2), (3, 2), (2, 3), (5, 3)])
def test_the_curve_visits_every_cell_by_single_steps(spark, bits, dimensions):
    rows = sorted((r.curve, r.cell) for r in curve.hilbert_table(spark, bits, dimensions).collect())
    assert [c for c, _ in rows] == list(range(1 << bits * dimensions))
    points = [[cell >> bits * d & (1 << bits) - 1 for d in range(dimensions)] for _, cell in rows]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(points, points[1:]))


def check(rows, result, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in result), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=str)
    by = {}
    for r in result:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r.slot)
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def order_of(rows):
    """The rows in curve order, by the table and a plain sort."""
    def cell(text, lang, source):
        import math
        top = lambda v: 0 if v is None else zlib.crc32(v.encode()) >> 27
        n = len((text or "").encode())
        return top(lang) << 10 | top(source) << 5 | min(31, max(0, math.floor(2 * math.log2(n + 1) - 8)))

    return [cell(t, lang, source) for _, t, lang, source in rows]


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    result = curve.shard_documents(docs).collect()
    check(rows, result, 24)
    place = {r.cell: r.curve for r in curve.hilbert_table(spark).collect()}
    want = [r[0] for _, _, _, r in sorted((place[c], zlib.crc32(r[1].encode()), r[0], r) for c, r in zip(order_of(rows), rows))]
    assert [r.doc_id for r in sorted(result, key=lambda r: (r.shard, r.slot))] == want


def test_skew_and_edge_cases(frame):
    rows = [(i, "same text", "en", "src") for i in range(300)] + [(7, "same text", "en", "src")] * 20
    rows += [(None, None, None, None), (None, None, None, None), (1000, "", "en", None), (1001, "é" * 500_000, None, "x")]
    docs = frame(rows, COLUMNS)
    check(rows, curve.shard_documents(docs.selectExpr("*", "1 AS cell", "2 AS shard", "3 AS rank", "4 AS row", "5 AS at")).collect(), 24)
    few = rows[:5]
    check(few, curve.shard_documents(frame(few, COLUMNS)).collect(), 24)
    assert curve.shard_documents(docs.limit(0)).count() == 0
    check(rows, curve.shard_documents(docs.drop("lang", "source"), 7).collect(), 7)


def test_written_shards(spark, frame, tmp_path):
    rows = [(i, f"text {i}" * (i % 40), "en", f"s{i % 3}") for i in range(200)]
    docs = frame(rows, COLUMNS).selectExpr("*", "1 AS shard")
    curve.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("doc_id", "text", "lang", "source").collect())) == sorted(rows)
    assert sorted(r["count"] for r in back.groupBy("_shard").count().collect()) == [50] * 4


def test_no_python_on_the_main_path(spark):
    plan = curve.shard_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
