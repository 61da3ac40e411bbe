"""Tiles and the rows of the catalogue."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from stationtide.operators.catalogue import asset_urls, row_hash, tile_parts
from stationtide.operators.tiling import assign_tiles, cluster_by_tile, space_batches, time_batches, with_bounds, with_coordinates
from stationtide.config import SpaceColumns
from stationtide.plans.products import largest_tile
from stationtide.functions.names import asset_bucket, asset_file, readable_size
from stationtide.suite.registry import query
from stationtide.suite.views import catalogue, hdr, placed_reports


def _tiled(spark, folder, lat=45, lon=45, time="month"):
    return assign_tiles(placed_reports(spark, folder), lat, lon, time)


@query("""SELECT report_id, strftime(month_start, '%Y-%m-%d') AS time_start, lat_start, lon_start FROM placed_tiles""")
def q_tile_assign(spark, folder):
    return _tiled(spark, folder).select("report_id", F.date_format("time_start", "yyyy-MM-dd").alias("time_start"), "lat_start", "lon_start")


@query("""SELECT dataset_source, strftime(month_start, '%Y-%m-%d') AS time_start, lat_start, lon_start, count(*) AS n_obs,
            count(DISTINCT primary_station_id) AS n_stations, count(DISTINCT observed_variable) AS n_variables
          FROM placed_tiles GROUP BY ALL""")
def q_tile_rollup(spark, folder):
    parts = tile_parts(_tiled(spark, folder).select(
        "time_start", "lat_start", "lon_start", "lat_size", "lon_size", "dataset_source", "primary_station_id",
        "observed_variable", "report_timestamp", "report_id"))
    rolled = parts.groupBy("dataset_source", "time_start", "lat_start", "lon_start").agg(
        F.sum("n_obs").alias("n_obs"), F.count_distinct("station").alias("n_stations"), F.count_distinct("variable").alias("n_variables"))
    return rolled.withColumn("time_start", F.date_format("time_start", "yyyy-MM-dd"))


@query("""SELECT strftime(month_start, '%Y-%m-%d') AS time_start, strftime(month_start + INTERVAL 1 MONTH, '%Y-%m-%d') AS time_end,
            lat_start, least(lat_start + 45, 90) AS lat_end, lon_start, least(lon_start + 45, 180) AS lon_end, count(*) AS n_obs
          FROM placed_tiles GROUP BY ALL""")
def q_tile_bounds(spark, folder):
    counted = _tiled(spark, folder).groupBy("time_start", "lat_start", "lon_start", "lat_size", "lon_size").agg(F.count(F.lit(1)).alias("n_obs"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return with_bounds(counted).select(day("time_start"), day("time_end"), "lat_start", "lat_end", "lon_start", "lon_end", "n_obs")


@query("""SELECT dataset_source, CAST(year(report_timestamp) AS INT) AS "year", lat_size, lon_size,
            CAST(floor((latitude + 90) / lat_size) * lat_size - 90 AS INT) AS lat_start,
            CAST(floor((longitude + 180) / lon_size) * lon_size - 180 AS INT) AS lon_start, count(*) AS n_obs FROM (
          SELECT *, CASE WHEN dataset_source = 'F' AND year(report_timestamp) <= 1997 THEN 90 WHEN dataset_source = 'F' THEN 30
            WHEN dataset_source = 'O' THEN 45 ELSE 20 END AS lat_size,
            CASE WHEN year(report_timestamp) <= 1998 THEN 180 ELSE 90 END AS lon_size FROM placed) GROUP BY ALL""")
def q_tile_size_by_year(spark, folder):
    lat = {"F": {"1990-1997": 90, "1997-2010": 30}, "O": 45, "P": {"1990-2010": 20}}
    tiled = _tiled(spark, folder, lat, {"1990-1998": 180, "1999-2010": 90}, "year")
    return tiled.groupBy("dataset_source", F.year("time_start").alias("year"), "lat_size", "lon_size", "lat_start", "lon_start").agg(
        F.count(F.lit(1)).alias("n_obs"))


@query("""SELECT dataset, version, dataset_source, asset, t0 AS time_coverage_start, t1 AS time_coverage_end, lat0 AS latitude_coverage_start,
            lat1 AS latitude_coverage_end, lon0 AS longitude_coverage_start, lon1 AS longitude_coverage_end,
            array_to_string(variables, ',') AS variables, array_to_string(stations, ',') AS stations, n_obs FROM cat""")
def q_tile_catalogue(spark, folder):
    entries = catalogue(spark, folder)
    return entries.select(
        "dataset", "version", "dataset_source", "asset", "time_coverage_start", "time_coverage_end", "latitude_coverage_start",
        "latitude_coverage_end", "longitude_coverage_start", "longitude_coverage_end",
        F.concat_ws(",", "variables").alias("variables"), F.concat_ws(",", "stations").alias("stations"), "n_obs")


@query("""SELECT dataset, dataset_source, asset, n_obs FROM (
            SELECT *, row_number() OVER (PARTITION BY dataset, dataset_source ORDER BY n_obs DESC, asset DESC) AS r FROM cat) WHERE r = 1""")
def q_largest_tile(spark, folder):
    entries = catalogue(spark, folder).withColumn("data_size", F.col("n_obs"))
    return largest_tile(entries).select("dataset", "dataset_source", "asset", "n_obs")


@query("""SELECT concat('https://store.example/', asset) AS url, 'orders' AS bucket, string_split(asset, '/')[2] AS file_name,
            concat(CAST(n_obs AS VARCHAR), '.0B') AS size FROM cat WHERE dataset_source = 'F'""")
def q_asset_urls(spark, folder):
    entries = catalogue(spark, folder).where(F.col("dataset_source") == "F")
    return asset_urls(entries, "https://store.example/").select(
        "url", asset_bucket(F.col("asset")).alias("bucket"), asset_file(F.col("asset")).alias("file_name"),
        readable_size(F.col("n_obs")).alias("size"))


@query("""SELECT lat_start, lon_start, count(*) AS n_obs, CAST(sum(report_id) AS BIGINT) AS id_sum, min(observation_value) AS min_value,
            max(observation_value) AS max_value, true AS same_after_reorder FROM placed_tiles GROUP BY 1, 2""")
def q_tile_checksum(spark, folder):
    """The content hash of a tile does not depend on row order or partitioning."""
    rows = _tiled(spark, folder).select("lat_start", "lon_start", "report_id", "observation_value")
    hashed = lambda df: df.withColumn("h", row_hash(["report_id", "observation_value"])).groupBy("lat_start", "lon_start")
    a = hashed(rows).agg(F.count(F.lit(1)).alias("n_obs"), F.sum("report_id").alias("id_sum"), F.min("observation_value").alias("min_value"),
                         F.max("observation_value").alias("max_value"), F.bit_xor("h").alias("hash_a"))
    b = hashed(rows.repartition(5, "report_id")).agg(F.bit_xor("h").alias("hash_b"))
    return a.join(b, ["lat_start", "lon_start"]).select(
        "lat_start", "lon_start", "n_obs", "id_sum", "min_value", "max_value", (F.col("hash_a") == F.col("hash_b")).alias("same_after_reorder"))


@query("""SELECT lat_start, lon_start, report_id, r AS position FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY lat_start, lon_start ORDER BY report_timestamp, latitude, longitude, report_id) AS INT) AS r FROM placed_tiles)
          WHERE r <= 3""")
def q_tile_sorted_topn(spark, folder):
    """First rows of each tile in storage order; Spark limits the groups before the shuffle."""
    order = Window.partitionBy("lat_start", "lon_start").orderBy("report_timestamp", "latitude", "longitude", "report_id")
    ranked = _tiled(spark, folder).withColumn("position", F.row_number().over(order))
    return ranked.where(F.col("position") <= 3).select("lat_start", "lon_start", "report_id", "position")


@query("""SELECT 'tiled' AS state, count(*) AS n_rows FROM placed WHERE latitude <> 0
          UNION ALL SELECT 'rejected', count(*) FROM placed WHERE latitude = 0""")
def q_null_coordinates(spark, folder):
    rows = placed_reports(spark, folder).withColumn("latitude", F.nullif("latitude", F.lit(0.0)))
    kept, rejected = with_coordinates(rows, SpaceColumns("longitude", "latitude"))
    counted = lambda df, state: df.agg(F.lit(state).alias("state"), F.count(F.lit(1)).alias("n_rows"))
    return counted(kept, "tiled").unionByName(counted(rejected, "rejected"))


@query("""SELECT strftime(m, '%Y-%m-%d') AS batch_start, strftime(m + INTERVAL 1 MONTH, '%Y-%m-%d') AS batch_end, coalesce(n, 0) AS n_rows
          FROM (SELECT unnest(generate_series(date_trunc('month', min(report_timestamp)), date_trunc('month', max(report_timestamp)), INTERVAL 1 MONTH)) AS m FROM hdr)
          LEFT JOIN (SELECT date_trunc('month', report_timestamp) AS k, count(*) AS n FROM hdr GROUP BY 1) ON k = m""")
def q_batches_month(spark, folder):
    batches = time_batches(hdr(spark, folder), "report_timestamp")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return batches.select(day("batch_start"), day("batch_end"), "n_rows")


@query("""SELECT strftime(y, '%Y-%m-%d') AS batch_start, CAST(lat AS INT) AS lat_start, CAST(lon AS INT) AS lon_start,
            CAST(lat + 90 AS INT) AS lat_end, CAST(lon + 90 AS INT) AS lon_end, coalesce(n, 0) AS n_rows
          FROM (SELECT unnest(generate_series(date_trunc('year', min(report_timestamp)), date_trunc('year', max(report_timestamp)), INTERVAL 1 YEAR)) AS y FROM placed)
          CROSS JOIN (VALUES (-90), (0)) AS a(lat) CROSS JOIN (VALUES (-180), (-90), (0), (90)) AS b(lon)
          LEFT JOIN (SELECT date_trunc('year', report_timestamp) AS k, CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS la,
            CAST(floor((longitude + 180) / 90) * 90 - 180 AS INT) AS lo, count(*) AS n FROM placed GROUP BY ALL) ON k = y AND la = lat AND lo = lon""")
def q_batches_space(spark, folder):
    rows = placed_reports(spark, folder)
    grid = space_batches(time_batches(rows, "report_timestamp", "year").drop("n_rows"), 90, 90)
    filled = assign_tiles(rows, 90, 90, "year").groupBy(F.col("time_start").alias("batch_start"), "lat_start", "lon_start").agg(F.count(F.lit(1)).alias("n"))
    out = grid.join(filled, ["batch_start", "lat_start", "lon_start"], "left")
    return out.select(F.date_format("batch_start", "yyyy-MM-dd").alias("batch_start"), "lat_start", "lon_start", "lat_end", "lon_end",
                      F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("""SELECT CASE WHEN lat_start < 0 THEN 'exists_different' ELSE 'exists_identical' END AS status, count(*) AS n_tiles
          FROM (SELECT lat_start, lon_start FROM placed_tiles WHERE report_id % 2 = 0 GROUP BY 1, 2) GROUP BY 1""")
def q_moved_values(spark, folder):
    """Values moved to the neighbouring column, where that one was null, change the status of their tiles and of no other."""
    rows = _tiled(spark, folder).where(F.col("report_id") % 2 == 0).select(
        "lat_start", "lon_start", "report_id", F.col("observation_value").alias("a"), F.lit(None).cast("double").alias("b"))
    moved = rows.select("lat_start", "lon_start", "report_id", F.when(F.col("lat_start") >= 0, F.col("a")).alias("a"),
                        F.when(F.col("lat_start") < 0, F.col("a")).alias("b"))
    hashed = lambda df, name: df.groupBy("lat_start", "lon_start").agg(F.bit_xor(row_hash(["report_id", "a", "b"])).alias(name))
    both = hashed(rows, "old").join(hashed(moved, "new"), ["lat_start", "lon_start"])
    status = F.when(F.col("old") == F.col("new"), "exists_identical").otherwise("exists_different")
    return both.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_tiles"))


@query("""SELECT lat_start, lon_start, count(*) AS n_obs, CAST(0 AS BIGINT) AS n_out_of_order FROM placed_tiles GROUP BY 1, 2""")
def q_tile_storage_order(spark, folder):
    """Rows as they are stored: inside each partition a tile's times ascend."""
    stored = cluster_by_tile(_tiled(spark, folder), ["lat_start", "lon_start"]).select(
        "lat_start", "lon_start", "report_timestamp", F.monotonically_increasing_id().alias("at"))
    part = F.shiftright("at", 33)
    before = F.lag("report_timestamp").over(Window.partitionBy("lat_start", "lon_start", part).orderBy("at"))
    checked = stored.withColumn("late", F.coalesce(before > F.col("report_timestamp"), F.lit(False)))
    return checked.groupBy("lat_start", "lon_start").agg(F.count(F.lit(1)).alias("n_obs"), F.count_if(F.col("late")).alias("n_out_of_order"))
