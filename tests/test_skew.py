"""One key holds a third of all rows: results stay whole and plans stay distributed."""

import pytest
from pyspark.sql import functions as F

from stationtide.operators.availability import availability
from stationtide.operators.catalogue import build_catalogue, missing_entries, tile_parts
from stationtide.operators.dedupe import first_per_key, repeated_keys
from stationtide.operators.joins import data_of_period, join_header_and_data
from stationtide.operators.tiling import assign_tiles, cluster_by_tile
from stationtide.functions.times import ts
from stationtide.session import broadcast_if_small

N = 30_000


@pytest.fixture
def rows(spark):
    """Reports of which every third belongs to report 0, station s0 and one tile."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, F.lit(0)).otherwise(F.col("id"))
    return spark.range(N, numPartitions=6).select(
        key.alias("report_id"), F.col("id").alias("observation_id"), F.concat(F.lit("s"), (key % 50).cast("string")).alias("primary_station_id"),
        F.when(hot, 1.0).otherwise((F.col("id") % 170 - 85).cast("double")).alias("latitude"),
        F.when(hot, 1.0).otherwise((F.col("id") % 350 - 175).cast("double")).alias("longitude"),
        F.timestamp_add("HOUR", F.col("id") % 600, F.lit("2020-01-01").cast("timestamp_ntz")).alias("report_timestamp"),
        F.concat(F.lit("v"), (F.col("id") % 4).cast("string")).alias("observed_variable"), F.col("id").cast("double").alias("observation_value"),
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_on_a_hot_report_is_complete(spark, rows):
    header = rows.select("report_id").distinct().withColumn("network", F.col("report_id") % 7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert join_header_and_data(header, rows).count() == N
        hot = data_of_period(rows, header.withColumn("when", ts("2020-01-01")), "when", ts("2020-01-01"), ts("2020-01-02"))
        assert hot.count() == N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_per_key_equals_brute_force(rows):
    shuffled = rows.select("report_id", "observation_value", "observation_id").orderBy(F.hash("observation_id"))
    picked = {r.report_id: r.observation_id for r in first_per_key(shuffled, ["report_id"], ["observation_value", "observation_id"]).collect()}
    expected = {}
    for i in range(N):
        expected.setdefault(0 if i % 3 == 0 else i, i)
    assert picked == expected
    assert "Window" not in plan_of(first_per_key(rows, ["report_id"], ["observation_id"]))
    assert [tuple(r) for r in repeated_keys(rows, ["report_id"]).collect()] == [(0, N // 3)]


def test_tiles_with_a_hot_tile_lose_no_row(rows):
    tiled = assign_tiles(rows, 10, 10).withColumns({"dataset": F.lit("d"), "version": F.lit("1.0.0"), "dataset_source": F.lit("s")})
    entries = build_catalogue(tile_parts(tiled), "month")
    assert entries.agg(F.sum("n_obs")).first()[0] == N
    assert entries.agg(F.max("n_obs")).first()[0] >= N // 3
    assert cluster_by_tile(tiled, ["time_start", "lat_start", "lon_start"]).count() == N
    # The shuffle for storage is one that adaptive execution may split.
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(cluster_by_tile(tiled, ["time_start", "lat_start", "lon_start"]))
    # Parts combine before the shuffle, and the check for stored entries compares no tile with all others.
    assert plan_of(tile_parts(tiled)).count("HashAggregate") >= 2
    check = plan_of(missing_entries(entries, entries))
    assert "CartesianProduct" not in check and "BroadcastNestedLoopJoin" not in check
    assert missing_entries(entries, entries).count() == 0


def test_availability_counts_each_cell_once(rows):
    cells = {(0 if i % 3 == 0 else i % 50, i % 600 // 24, i % 4) for i in range(N)}
    assert availability(rows).count() == len(cells)


def test_sides_are_broadcast_only_when_small(spark):
    assert "broadcast" in broadcast_if_small(spark.range(10), 10)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in broadcast_if_small(spark.range(11), 10)._jdf.queryExecution().analyzed().toString().lower()
