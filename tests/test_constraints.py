import json
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stationtide.operators.availability import (
    availability, bitmap_size, bitmap_table, constraint_size, constraint_table, constraints_to_json, day_bitmaps, days_of, decode_constraints, encode_constraints,
    json_fragments, merge_constraints, positions_of, write_entry_json,
)
from stationtide.operators.factorise import compress, expand, partial_expand, request_set

ENCODED = "entry int, stations array<string>, days array<date>, variable_constraints map<string, array<int>>"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_decode_uses_station_then_day_positions(frame):
    encoded = frame([(1, ["7", "8"], [date(2000, 1, 1)], {"tas": [1]})], ENCODED)
    table = constraint_table(encoded, ["entry"], ["tas"])
    assert {(r.station, r.tas) for r in table.collect()} == {("7", False), ("8", True)}


def test_merged_constraints_golden_case(frame):
    jan2, jan4 = date(1998, 1, 2), date(1998, 1, 4)
    encoded = frame([
        (1, ["7"], [jan2, jan4], {"air_pressure": [0, 1]}),
        (2, ["7", "8"], [jan2], {"air_pressure": [1], "column_burden": [0]}),
    ], ENCODED)
    rows = decode_constraints(encoded, ["entry"]).withColumns({"source": F.lit("OzoneSonde"), "version": F.lit("1.0.0")})
    merged = merge_constraints(rows, ["air_pressure", "column_burden"]).orderBy("time")
    assert [tuple(r) for r in merged.collect()] == [
        (jan2, "OzoneSonde", "1.0.0", True, True), (jan4, "OzoneSonde", "1.0.0", True, False)]


def test_encode_is_the_inverse_of_decode(frame):
    rows = frame([
        (1, "b", date(2000, 1, 1), "x"), (1, "a", date(2000, 1, 3), "x"), (1, "a", date(2000, 1, 1), "y"),
        (2, "a", date(2000, 1, 2), "y"),
    ], "entry int, station string, day date, variable string")
    encoded = encode_constraints(rows, ["entry"])
    first = encoded.where("entry = 1").first()
    assert first.stations == ["a", "b"] and first.variable_constraints == {"x": [1, 2], "y": [0]}
    assert as_set(decode_constraints(encoded, ["entry"]).select("entry", "station", "day", "variable")) == as_set(rows)
    assert as_set(constraint_size(encoded, ["entry"])) == {(1, 6), (2, 1)}


def test_hours_of_six_years_factorise(spark):
    hours = spark.range((datetime(2005, 12, 31) - datetime(2000, 1, 1)) // timedelta(hours=1) + 1)
    at = F.timestamp_add("HOUR", F.col("id"), F.lit("2000-01-01").cast("timestamp_ntz"))
    days = hours.select(F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"))
    boxes = compress(days)
    # Long months and short months share their years; February differs in leap years.
    assert boxes.count() <= 6
    assert as_set(expand(boxes).select("year", "month", "day")) == as_set(days.distinct())
    assert expand(boxes).count() == days.distinct().count()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.integers(0, 2)), min_size=1, max_size=25))
def test_expand_of_compress_is_the_distinct_input(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string, c int")
    boxes = compress(df)
    out = expand(boxes)
    assert out.count() == len(set(rows)) and as_set(out.select("a", "b", "c")) == set(rows)
    assert boxes.count() <= len(set(rows))


def test_null_cells_survive_compression(frame):
    rows = frame([(1, None), (2, None), (1, "x"), (1, "x")], "a int, b string")
    assert as_set(expand(compress(rows))) == {(1, None), (2, None), (1, "x")}


def test_partial_expand_joins_kept_lists(frame):
    boxes = frame([([1, 2], ["x"], ["p"]), ([2], ["x"], ["q"])], "a array<int>, b array<string>, c array<string>")
    out = {(r.a, r.b): r.c for r in partial_expand(boxes, ["c"]).collect()}
    assert out == {(1, "x"): ["p"], (2, "x"): ["p", "q"]}
    requests = request_set(boxes, ["c"], 1, "small").collect()
    assert len(requests) == 1 and requests[0].a == 1 and requests[0].format in ("csv", "netcdf")


def test_availability_has_day_granularity(frame):
    rows = frame([("7", datetime(2000, 1, 1, 3), "t"), ("7", datetime(2000, 1, 1, 9), "t"), ("7", datetime(2000, 1, 2), "t")],
                 "primary_station_id string, report_timestamp timestamp_ntz, observed_variable string")
    assert availability(rows).count() == 2


CELLS = "entry int, station string, day date, variable string"


def cells(n=400):
    """Cells over two years, quotes and commas in names."""
    out = {(1 + i % 2, f's"{i * 7 % 13},', date(2000, 1, 1) + timedelta(days=i * i % 700), f"v{i % 3}") for i in range(n)}
    return sorted(out | {(3, "only", date(1999, 12, 31), "x")})


def test_bitmaps_and_back(frame):
    rows = frame(cells(), CELLS)
    bitmaps = day_bitmaps(rows, ["entry"])
    assert as_set(days_of(bitmaps, ["entry"]).select("entry", "station", "day", "variable")) == set(cells())
    # A row grows with the days of its entry, 64 of them to a word.
    assert bitmaps.select(F.max(F.size("words"))).first()[0] <= 700 // 64 + 1
    encoded = encode_constraints(rows, ["entry"])
    assert as_set(bitmap_size(bitmaps, ["entry"])) == as_set(constraint_size(encoded, ["entry"]))
    names = ["v0", "v1", "v2", "x"]
    assert as_set(bitmap_table(bitmaps, ["entry"], names)) == as_set(constraint_table(encoded, ["entry"], names))
    nested = {(r.entry, v, p) for r in encoded.collect() for v, ps in r.variable_constraints.items() for p in ps}
    assert as_set(positions_of(bitmaps, ["entry"])) == nested


def test_json_in_pieces_is_the_same_object(spark, frame, tmp_path):
    rows = frame(cells(), CELLS)
    bitmaps = day_bitmaps(rows, ["entry"])
    whole = {r.entry: json.loads(r.json) for r in constraints_to_json(encode_constraints(rows, ["entry"]), ["entry"]).collect()}
    for step in (50, 10_000):
        pieces = json_fragments(bitmaps, ["entry"], step).orderBy("entry", "part", "at").collect()
        texts = {e: "".join(r.text for r in pieces if r.entry == e) for e in whole}
        assert {e: json.loads(t) for e, t in texts.items()} == whole
        assert max(len(r.text) for r in pieces) <= 30 + step * 6
    write_entry_json(bitmaps, ["entry"], str(tmp_path / "json"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "json").glob("part-*")))
    decoder, found = json.JSONDecoder(), []
    while text.strip():
        value, end = decoder.raw_decode(text.lstrip())
        found.append(value)
        text = text.lstrip()[end:]
    assert found == [whole[e] for e in sorted(whole)]


def test_no_set_is_a_shuffle_key(spark, monkeypatch):
    from stationtide.operators import factorise

    plans = []
    real = factorise.cut_lineage
    monkeypatch.setattr(factorise, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    days = spark.range(200).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).cast("string").alias("b"), F.floor(F.col("id") / 50).alias("c"))
    boxes = compress(days)
    assert as_set(expand(boxes)) == as_set(days.distinct())
    keys = [line for p in plans for line in p.splitlines() if "hashpartitioning" in line]
    assert keys and not any("[]" in k or "array" in k for k in keys)
