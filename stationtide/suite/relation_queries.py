"""Joins, normal forms, archives, duplicates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Window, functions as F

from stationtide.functions.times import ts
from stationtide.model.definitions import TableDefinition, TableGraph, default_graph
from stationtide.model.literals import literal_table
from stationtide.operators.archive import batch_stations, fix_units, fix_values, merge_bias, record_intervals, rows_of_intervals, slice_bounds
from stationtide.operators.dedupe import distinct_rows, first_per_key, repeated_keys
from stationtide.operators.joins import (
    active_stations_by_month, align_by_position, column_conflicts, data_of_period, headers_of_first,
    join_header_and_data, join_tables, store_by_position, subset_archive,
)
from stationtide.operators.relational import denormalise, normalise, normalise_table
from stationtide.session import scratch_path
from stationtide.sources.archive import read_archive
from stationtide.sources.tables import discovered_types
from stationtide.suite.registry import query
from stationtide.suite.views import hdr, obs, placed_reports, station, table, wide


@query("""SELECT h.report_id, h.dataset_source, h.observed_variable, w.level, w.quantity, w.price
          FROM hdr h JOIN wide w ON h.report_id = w.report_id""")
def q_header_data_join(spark, folder):
    joined = join_header_and_data(hdr(spark, folder), wide(spark, folder))
    return joined.select("report_id", "dataset_source", "observed_variable", "level", "quantity", "price")


@query("""SELECT w.report_id, w.level, w.price FROM wide w WHERE EXISTS (
            SELECT 1 FROM hdr h WHERE h.report_id = w.report_id
            AND h.report_timestamp >= TIMESTAMP '1997-01-01' AND h.report_timestamp < TIMESTAMP '1998-01-01')""")
def q_header_data_semi(spark, folder):
    rows = data_of_period(wide(spark, folder), hdr(spark, folder), "report_timestamp", ts("1997-01-01"), ts("1998-01-01"))
    return rows.select("report_id", "level", "price")


@query("""SELECT t.c AS "column", CASE t.c WHEN 'status' THEN n1 ELSE n2 END AS n_conflicts, n_rows FROM (
          SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM l_linestatus) AS n1,
            count(*) FILTER (WHERE year(o_orderdate) IS DISTINCT FROM nullif(year(l_shipdate), 1999)) AS n2
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey) CROSS JOIN (VALUES ('status'), ('year')) AS t(c)""")
def q_conflict_check(spark, folder):
    header = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("report_id"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    data = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("report_id"), F.col("l_linestatus").alias("status"),
        F.nullif(F.year("l_shipdate"), F.lit(1999)).alias("year"))
    return column_conflicts(header, data)


def _flat(spark, folder):
    reports = placed_reports(spark, folder)
    names = station(spark, folder).select("station_key", "station_name")
    return reports.join(names, "station_key").select(
        "report_id", "report_timestamp", "primary_station_id", "station_record_number",
        F.col("station_name").alias("station_name|station_configuration"),
        F.col("latitude").alias("latitude|header_table"), F.col("longitude").alias("longitude|header_table"),
        F.concat(F.lit("o"), F.col("report_id").cast("string")).alias("observation_id"), "observed_variable", "observation_value",
    )


@query("""SELECT report_id, report_timestamp, primary_station_id, station_record_number, latitude, longitude FROM placed""")
def q_normalise_header(spark, folder):
    return normalise_table(_flat(spark, folder), default_graph(), "header_table")


@query("""SELECT 'header_table' AS "table", count(*) AS n_rows FROM (SELECT DISTINCT report_id, report_timestamp, primary_station_id, station_record_number, latitude, longitude FROM placed)
          UNION ALL SELECT 'station_configuration', count(*) FROM (SELECT DISTINCT s.station_name, s.primary_station_id FROM hdr h JOIN station s ON h.station_key = s.station_key)""")
def q_normalise_all(spark, folder):
    """Every table that the flat columns can fill, at once."""
    tables = normalise(_flat(spark, folder), default_graph())
    counts = [tables[name].agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows")) for name in ("header_table", "station_configuration")]
    return counts[0].unionByName(counts[1])


@query("""SELECT DISTINCT s.station_name, s.primary_station_id AS primary_id, 1 AS record_number
          FROM hdr h JOIN station s ON h.station_key = s.station_key""")
def q_normalise_station(spark, folder):
    return normalise_table(_flat(spark, folder), default_graph(), "station_configuration")


@query("""SELECT concat(w.report_id, '-', w.level, '-', w.price) AS observation_id, p.report_id, p.report_timestamp, s.station_name,
            p.primary_station_id, p.latitude AS lat_report, s.latitude AS lat_station, w.price AS observation_value
          FROM wide w JOIN placed p ON w.report_id = p.report_id JOIN station s ON s.primary_station_id = p.primary_station_id""")
def q_denormalise(spark, folder):
    observations = wide(spark, folder).select(
        F.concat_ws("-", "report_id", "level", "price").alias("observation_id"), "report_id", F.col("price").alias("observation_value"))
    headers = placed_reports(spark, folder).select(
        "report_id", "report_timestamp", "primary_station_id", "station_record_number", "latitude", "longitude")
    stations = station(spark, folder).select(
        F.col("primary_station_id").alias("primary_id"), "record_number", "station_name", "latitude", "longitude")
    flat = denormalise({"observations_table": observations, "header_table": headers, "station_configuration": stations}, default_graph())
    return flat.select(
        "observation_id", "report_id", "report_timestamp", "station_name", "primary_station_id",
        F.col("`latitude|header_table`").alias("lat_report"), F.col("`latitude|station_configuration`").alias("lat_station"), "observation_value")


@query("""SELECT p.report_id, p.latitude + 1 AS "latitude|header", s.latitude AS "latitude|station", s.station_name
          FROM placed p JOIN station s ON p.primary_station_id = s.primary_station_id""")
def q_suffix_collision(spark, folder):
    headers = placed_reports(spark, folder).select("report_id", "primary_station_id", (F.col("latitude") + 1).alias("latitude"))
    stations = station(spark, folder).select(F.col("primary_station_id").alias("primary_id"), "latitude", "station_name")
    joined = join_tables(headers, stations, [("primary_station_id", "primary_id")], "header", "station")
    return joined.select("report_id", "`latitude|header`", "`latitude|station`", "station_name")


@query("""SELECT observation_id, observation_value, observation_value * 0.5 AS departure FROM obs""")
def q_positional_align(spark, folder):
    """The feedback table has no key; both tables carry the row's position in their source file."""
    position = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")]
    events = spark.read.parquet(f"{folder}/events.parquet")
    observations = events.select(*position, F.col("event_id").alias("observation_id"), F.col("value").alias("observation_value"))
    feedback = events.select(*position, (F.col("value") * 0.5).alias("departure"))
    return align_by_position(observations, feedback, ["source_file", "source_row"]).drop("source_file", "source_row")


@query("""SELECT observation_id, observation_value, observation_value * 0.5 AS departure FROM obs""")
def q_aligned_buckets(spark, folder):
    """The same alignment of tables that were stored by position: bucket joins bucket, and nothing is shuffled."""
    position = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")]
    events = spark.read.parquet(f"{folder}/events.parquet")
    sides = {"observations": events.select(*position, F.col("event_id").alias("observation_id"), F.col("value").alias("observation_value")),
             "feedback": events.select(*position, (F.col("value") * 0.5).alias("departure"))}
    stored = []
    for side, frame in sides.items():
        path = scratch_path(spark, side)
        stored.append(store_by_position(frame, ["source_file", "source_row"], path.rsplit("/", 1)[1].replace("-", "_"), path, 8))
    return align_by_position(*stored, ["source_file", "source_row"], check=False).drop("source_file", "source_row")


@query("""SELECT observation_id, observed_variable FROM obs WHERE report_timestamp >= TIMESTAMP '2024-01-10' AND report_timestamp < TIMESTAMP '2024-01-17'""")
def q_record_intervals(spark, folder):
    """Rows of a week from a table sorted by variable and date, through the positions of its daily records."""
    place = Window.partitionBy("file").orderBy("observed_variable", "report_timestamp", "observation_id")
    path = scratch_path(spark, "sorted")
    rows = obs(spark, folder).withColumn("file", F.pmod(F.crc32("primary_station_id"), F.lit(5)))
    rows.withColumn("row", F.row_number().over(place) - 1).sortWithinPartitions("file", "row").write.parquet(path)
    table = spark.read.parquet(path)
    index = table.groupBy("file", "observed_variable", F.date_trunc("day", "report_timestamp").cast("timestamp_ntz").alias("record_timestamp")).agg(F.min("row").alias("position"))
    found = rows_of_intervals(table, record_intervals(index, ts("2024-01-10"), ts("2024-01-17")))
    return found.select("observation_id", "observed_variable")


@query("""WITH h AS (SELECT column_name AS c, column_type AS t FROM (DESCRIBE SELECT * FROM orders)), d AS (SELECT column_name AS c, column_type AS t FROM (DESCRIBE
              SELECT *, CAST(NULL AS VARCHAR) AS o_orderdate FROM lineitem)),
            b AS (SELECT c, t FROM h UNION ALL SELECT c, t FROM d WHERE c NOT IN (SELECT c FROM h))
          SELECT c AS "column", CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(t) END AS type FROM b""")
def q_discovered_types(spark, folder):
    """Columns of a header and a data table that clash in one name: the header's type counts."""
    header = spark.read.parquet(f"{folder}/orders.parquet")
    data = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("o_orderdate", F.lit(None).cast("string"))
    text = pa.string()
    return literal_table(spark, [("column", text), ("type", text)], sorted(discovered_types(header, data).items()))


@query("""SELECT strftime(m, '%Y-%m-%d') AS month, count(*) AS n_stations FROM (
            SELECT unnest(generate_series(date_trunc('month', a) + CASE WHEN a > date_trunc('month', a) THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END,
              date_trunc('month', b), INTERVAL 1 MONTH)) AS m
            FROM (SELECT station_key, min(report_timestamp) AS a, max(report_timestamp) AS b FROM hdr GROUP BY 1)) GROUP BY 1""")
def q_station_active_months(spark, folder):
    span = hdr(spark, folder).groupBy("station_key").agg(
        F.min("report_timestamp").alias("first_report"), F.max("report_timestamp").alias("last_report"))
    months = active_stations_by_month(span, "first_report", "last_report")
    return months.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "n_stations")


@query("""SELECT primary_station_id, n_reports FROM (
            SELECT s.primary_station_id, s.latitude, s.longitude, min(h.report_timestamp) AS a, max(h.report_timestamp) AS b, count(*) AS n_reports
            FROM hdr h JOIN station s ON h.station_key = s.station_key GROUP BY ALL)
          WHERE a < TIMESTAMP '1996-01-01' AND b >= TIMESTAMP '1995-06-01'
            AND (contains(primary_station_id, '0-20999-0') OR (longitude >= -60 AND longitude < 60 AND latitude >= -30 AND latitude < 70))""")
def q_ship_station_filter(spark, folder):
    stations = placed_reports(spark, folder).groupBy("primary_station_id", "latitude", "longitude").agg(
        F.min("report_timestamp").alias("record_start"), F.max("report_timestamp").alias("record_end"), F.count(F.lit(1)).alias("n_reports"))
    chosen = batch_stations(stations, ts("1995-06-01"), ts("1996-01-01"), (-60, 60, -30, 70))
    return chosen.select("primary_station_id", "n_reports")


def _archive_tables(spark, folder):
    """Archive-like tables: observations by position, reports, stations with repeated records, feedback."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    observations = lines.select(
        "file", "row", F.concat_ws("#", "file", "row").alias("observation_id"), F.col("l_orderkey").alias("report_id"),
        F.col("l_linenumber").alias("observed_variable"), F.col("l_extendedprice").alias("observation_value"),
        F.lit("x").alias("expver"))
    headers = placed_reports(spark, folder).select(
        "report_id", "report_timestamp", "primary_station_id", "station_record_number", "latitude", "longitude",
        F.lit("old name").alias("station_name"))
    stations = station(spark, folder).select(
        F.col("primary_station_id").alias("primary_id"), "record_number", "station_name", "latitude", "longitude")
    feedback = lines.select("file", "row", (F.col("l_tax") * 2).alias("fg_depar@body"), F.lit(0).alias("stream"))
    return {"observations_table": observations, "header_table": headers,
            "station_configuration": stations.unionByName(stations), "era5fb_table": feedback}


def _archive_graph():
    extra = TableDefinition("era5fb_table", (
        ("obs_id", "varchar (pk)", "observations_table:observation_id"), ("fg_depar@body", "numeric", "")))
    graph = default_graph()
    return TableGraph.of([*graph.values(), extra])


@query("""SELECT w.l_orderkey AS report_id, w.l_linenumber AS observed_variable, w.l_extendedprice AS observation_value,
            w.l_tax * 2 AS departure, s.station_name
          FROM lineitem w JOIN placed p ON w.l_orderkey = p.report_id JOIN station s ON p.primary_station_id = s.primary_station_id
          WHERE p.report_timestamp >= TIMESTAMP '1996-01-01' AND p.report_timestamp < TIMESTAMP '1996-07-01'
            AND p.longitude >= -100 AND p.longitude < 100 AND p.latitude >= -60 AND p.latitude < 60""")
def q_archive_denormalise(spark, folder):
    flat = read_archive(_archive_tables(spark, folder), _archive_graph(), ts("1996-01-01"), ts("1996-07-01"), (-100, 100, -60, 60), ["file", "row"])
    return flat.select("report_id", "observed_variable", "observation_value", F.col("`fg_depar@body`").alias("departure"), "station_name")


@query("""SELECT 'observations_table' AS "table", count(*) AS n_rows FROM obs WHERE report_timestamp >= TIMESTAMP '2024-01-10' AND report_timestamp < TIMESTAMP '2024-01-12'
          UNION ALL SELECT 'header_table', count(DISTINCT report_id) FROM obs WHERE report_timestamp >= TIMESTAMP '2024-01-10' AND report_timestamp < TIMESTAMP '2024-01-12'
          UNION ALL SELECT 'station_configuration', count(DISTINCT primary_station_id) FROM obs WHERE report_id IN (
            SELECT report_id FROM obs WHERE report_timestamp >= TIMESTAMP '2024-01-10' AND report_timestamp < TIMESTAMP '2024-01-12') AND observation_id % 10 = 0
          UNION ALL SELECT 'first_hundred', (SELECT count(DISTINCT report_id) FROM (SELECT report_id FROM obs ORDER BY report_timestamp, observation_id LIMIT 100))""")
def q_archive_subset(spark, folder):
    rows = obs(spark, folder)
    headers = rows.where(F.col("observation_id") == F.col("report_id")).select("report_id", "primary_station_id")
    stations = rows.select(F.col("primary_station_id").alias("primary_id")).distinct()
    tables = subset_archive({"observations_table": rows, "header_table": headers, "station_configuration": stations},
                            "report_timestamp", ts("2024-01-10"), ts("2024-01-12"))
    first = headers_of_first(headers, rows, ["report_timestamp", "observation_id"], 100)
    counts = [f.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("n_rows")) for n, f in {**tables, "first_hundred": first}.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


_CODE = "CASE observed_variable WHEN 'click' THEN 0 WHEN 'view' THEN 117 WHEN 'error' THEN 138 WHEN 'signup' THEN 106 ELSE 126 END"


def _coded(spark, folder):
    name = F.col("observed_variable")
    code = F.when(name == "click", 0).when(name == "view", 117).when(name == "error", 138).when(name == "signup", 106).otherwise(126)
    return obs(spark, folder).withColumn("observed_variable", code)


@query(f"""SELECT observation_id, CASE {_CODE} WHEN 138 THEN observation_value * 100.0 WHEN 117 THEN observation_value / CAST(9.80665 AS DOUBLE) ELSE observation_value END AS observation_value,
            CASE {_CODE} WHEN 138 THEN observation_id * 100.0 WHEN 117 THEN observation_id / CAST(9.80665 AS DOUBLE) ELSE observation_id END AS departure,
            CASE {_CODE} WHEN 138 THEN observation_value * 100.0 ELSE observation_value END AS homogenisation_adjustment,
            CASE {_CODE} WHEN 138 THEN 300 WHEN 117 THEN 631 ELSE 5 END AS units FROM obs""")
def q_unit_fix_archive(spark, folder):
    rows = _coded(spark, folder).withColumns({
        "fg_depar@body": F.col("observation_id").cast("double"), "homogenisation_adjustment": F.col("observation_value"), "units": F.lit(5)})
    return fix_units(rows).select("observation_id", "observation_value", F.col("`fg_depar@body`").alias("departure"), "homogenisation_adjustment", "units")


@query(f"""SELECT observation_id, CASE {_CODE} WHEN 138 THEN observation_value + 1 WHEN 106 THEN observation_value + 2 ELSE observation_value END AS homogenisation_adjustment FROM obs""")
def q_bias_merge(spark, folder):
    value = F.col("observation_value")
    rows = _coded(spark, folder).withColumns({
        "RISE_bias_estimate": value, "humidity_bias_estimate": value + 1, "wind_bias_estimate": value + 2})
    return merge_bias(rows).select("observation_id", "homogenisation_adjustment")


@query(f"""SELECT observation_id, report_id AS profile_id, latitude + 0.25 AS latitude, longitude - 0.5 AS longitude,
            observation_id + 60 AS date_time, 2 AS quality_flag FROM obs WHERE {_CODE} <> 0""")
def q_displacement(spark, folder):
    from stationtide.operators.archive import apply_displacement

    rows = _coded(spark, folder).withColumns({
        "latd": F.lit(0.25), "lond": F.lit(-0.5), "date_time": F.col("observation_id"), "timed": F.lit(60)})
    return fix_values(apply_displacement(rows)).select("observation_id", "profile_id", "latitude", "longitude", "date_time", "quality_flag")


@query("""SELECT observed_variable, min(observation_id) AS first_position, max(observation_id) AS last_position, count(*) AS n_rows FROM obs
          WHERE report_timestamp >= TIMESTAMP '2024-01-10' AND report_timestamp < TIMESTAMP '2024-01-17' GROUP BY 1""")
def q_record_slices(spark, folder):
    return slice_bounds(obs(spark, folder), "observation_id", "report_timestamp", ts("2024-01-10"), ts("2024-01-17"))


@query("""SELECT report_id, level, price, quantity FROM (
            SELECT *, row_number() OVER (PARTITION BY report_id, level ORDER BY price, quantity) AS n FROM wide) WHERE n = 1""")
def q_dedupe_first(spark, folder):
    rows = wide(spark, folder).select("report_id", "level", "price", "quantity")
    return first_per_key(rows, ["report_id", "level"], ["price", "quantity"])


@query("""SELECT DISTINCT report_id, level, price_quality_flag IS NULL AS unflagged FROM wide""")
def q_dedupe_rows(spark, folder):
    return distinct_rows(wide(spark, folder).select("report_id", "level", F.col("price_quality_flag").isNull().alias("unflagged")))


@query("""SELECT report_id, level, count(*) AS n_rows FROM wide GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dup_keys(spark, folder):
    return repeated_keys(wide(spark, folder), ["report_id", "level"])
