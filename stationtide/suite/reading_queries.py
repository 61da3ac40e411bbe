"""Scans, code tables, exports."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from stationtide.config import DatasetConfig, Description, SourceConfig
from stationtide.functions.times import ts
from stationtide.model.codes import read_code_table
from stationtide.model.definitions import default_graph, read_definitions
from stationtide.model.literals import literal_table, name_table
from stationtide.operators.archive import in_box
from stationtide.operators.codes import decode_variables, encode_variables
from stationtide.operators.homogenise import legal_field_report
from stationtide.operators.quality import config_problems, stored_field_report
from stationtide.operators.relational import key_integrity
from stationtide.operators.tiling import assign_tiles
from stationtide.session import scratch_path
from stationtide.sources.archive import read_station_index_lines
from stationtide.sources.flat import existing_paths, expand_template, read_flat_csv, read_flat_parquet, read_month_partitions, time_slice
from stationtide.sources.registry import read_source
from stationtide.sources.store import export_flat, read_tiles, write_tiles
from stationtide.sources.tables import read_single_table
from stationtide.suite.registry import query
from stationtide.suite.views import hdr, obs, placed_reports, station, table, varcode, wide


@query("""SELECT event_id, ts, event_type, value FROM events
          WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""")
def q_time_batch_scan(spark, folder):
    rows = read_flat_parquet(spark, f"{folder}/events.parquet", ts("2024-01-10"), ts("2024-01-20"), time_column="ts")
    return rows.select("event_id", "ts", "event_type", "value")


@query("""SELECT observation_id, primary_station_id, latitude, longitude FROM obs
          WHERE longitude >= -90 AND longitude < 45 AND latitude >= -45 AND latitude < 60""")
def q_space_batch_filter(spark, folder):
    rows = obs(spark, folder).where(in_box((-90, 45, -45, 60)))
    return rows.select("observation_id", "primary_station_id", "latitude", "longitude")


@query("""SELECT report_id, dataset_source, report_timestamp FROM hdr
          WHERE report_timestamp >= TIMESTAMP '1996-03-01' AND report_timestamp < TIMESTAMP '1996-06-01'""")
def q_path_template_scan(spark, folder):
    root = scratch_path(spark, "months")
    rows = hdr(spark, folder).withColumns({"year": F.year("report_timestamp"), "month": F.month("report_timestamp")})
    rows.hint("rebalance", F.col("year"), F.col("month")).write.partitionBy("year", "month").parquet(root)
    names = expand_template("year={year}/month={month}", "orders", "all", [(1996, m) for m in range(3, 7)])
    paths = existing_paths(spark, [f"{root}/{n}" for n in names])
    by_name = time_slice(spark.read.parquet(*paths), ts("1996-03-01"), ts("1996-05-01"))
    by_partition = read_month_partitions(spark, root, datetime(1996, 5, 1), datetime(1996, 6, 1))
    return by_name.unionByName(by_partition).select("report_id", "dataset_source", "report_timestamp")


_ORDERS = SourceConfig(
    main_variables=("o_totalprice",), data_table="orders", order_by=("o_orderkey",),
    rename={"o_orderdate": "report_timestamp"},
    descriptions={"report_timestamp": Description("datetime64[ns]"), "o_totalprice": Description("float64")},
)


@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
          WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def q_single_table_scan(spark, folder):
    rows = read_single_table(table(spark, folder, "orders"), _ORDERS, ts("1997-01-01"), ts("1998-01-01"), ordered=True)
    return rows.select("o_orderkey", "o_orderdate", "o_totalprice")


@query("""SELECT replace(n_name, ' ', '_') AS country, count(*) AS n_stations
          FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def q_code_table(spark, folder):
    root = scratch_path(spark, "codes")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name"))
    nations.write.option("header", True).csv(f"{root}/country.csv")
    codes = read_code_table(spark, root, "country")
    rows = station(spark, folder).select("country")
    return decode_variables(rows, codes, "country").groupBy("country").agg(F.count(F.lit(1)).alias("n_stations"))


@query("""SELECT observation_id, observed_variable, observation_value, strftime(report_timestamp, '%Y-%m-01') AS time_start,
          CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS lat_start,
          CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lon_start FROM obs""")
def q_stored_tile_read(spark, folder):
    root = scratch_path(spark, "tiles")
    coded = encode_variables(obs(spark, folder), varcode(spark))
    write_tiles(assign_tiles(coded, 90, 180), root, "first", {"dataset": "events", "version": "1.0.0", "dataset_source": "events"})
    rows = decode_variables(read_tiles(spark, root), varcode(spark))
    return rows.select("observation_id", "observed_variable", "observation_value",
                       F.date_format("time_start", "yyyy-MM-dd").alias("time_start"), "lat_start", "lon_start")


def _header_columns(spark, folder):
    return hdr(spark, folder).select(
        "report_id", "station_record_number", "report_timestamp", "observed_variable", "observation_value",
        F.lit(None).cast("double").alias("latitude"), F.lit("x").alias("not_a_field"))


@query("""SELECT c AS "column", n AS n_values, legal, n_tables, ambiguous FROM (
          SELECT unnest([
            {'c': 'report_id', 'n': count(report_id), 'legal': true, 'n_tables': CAST(2 AS BIGINT), 'ambiguous': false},
            {'c': 'station_record_number', 'n': count(station_record_number), 'legal': true, 'n_tables': CAST(1 AS BIGINT), 'ambiguous': false},
            {'c': 'report_timestamp', 'n': count(report_timestamp), 'legal': true, 'n_tables': CAST(1 AS BIGINT), 'ambiguous': false},
            {'c': 'observed_variable', 'n': count(observed_variable), 'legal': true, 'n_tables': CAST(1 AS BIGINT), 'ambiguous': false},
            {'c': 'observation_value', 'n': count(observation_value), 'legal': true, 'n_tables': CAST(1 AS BIGINT), 'ambiguous': false},
            {'c': 'latitude', 'n': CAST(0 AS BIGINT), 'legal': true, 'n_tables': CAST(3 AS BIGINT), 'ambiguous': true},
            {'c': 'not_a_field', 'n': count(*), 'legal': false, 'n_tables': CAST(0 AS BIGINT), 'ambiguous': false}
          ], recursive := true) FROM hdr) """)
def q_legal_fields(spark, folder):
    return legal_field_report(_header_columns(spark, folder), default_graph())


@query("""SELECT 'header_table' AS child, 'primary_station_id,station_record_number' AS field, 'station_configuration' AS parent,
            'primary_id,record_number' AS parent_field, count(*) AS n_rows, count(*) FILTER (WHERE o.o_orderkey % 11 = 0) AS n_null,
            count(*) FILTER (WHERE o.o_orderkey % 11 <> 0 AND s.c_custkey IS NULL) AS n_orphans
          FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) s ON o.o_custkey = s.c_custkey AND o.o_orderkey % 3 <> 1
          UNION ALL
          SELECT 'observations_table', 'report_id', 'header_table', 'report_id', count(*), 0,
            count(*) FILTER (WHERE o.o_orderkey IS NULL)
          FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_totalprice >= 50000) o ON l.l_orderkey = o.o_orderkey""")
def q_fk_children(spark, folder):
    # The parents lack some rows on purpose; a part of the reports has half of its key right, another a null in it.
    stations = station(spark, folder)
    parents = stations.where(F.col("station_key") % 7 != 0).select(
        F.col("primary_station_id").alias("primary_id"), "record_number", "station_name")
    headers = hdr(spark, folder).join(stations.select("station_key", "primary_station_id"), "station_key")
    links = {
        "header_table": headers.select("report_id", "primary_station_id", F.when(F.col("report_id") % 11 != 0, F.when(
            F.col("report_id") % 3 == 1, 2).otherwise(F.col("station_record_number"))).alias("station_record_number")),
        "station_configuration": parents,
    }
    reports = {"header_table": hdr(spark, folder).where(F.col("observation_value") >= 50000).select("report_id"),
               "observations_table": wide(spark, folder).select("report_id")}
    graph = default_graph()
    return key_integrity(links, graph).unionByName(key_integrity(reports, graph))


@query("""SELECT child, field, parent, parent_field, depth, count(*) AS n_values FROM (
            SELECT 'header_table' AS child, 'primary_station_id' AS field, 'station_configuration' AS parent, 'primary_id' AS parent_field, 1 AS depth FROM hdr
            UNION ALL SELECT 'header_table', 'station_record_number', 'station_configuration', 'record_number', 1 FROM hdr
            UNION ALL SELECT 'observations_table', 'report_id', 'header_table', 'report_id', 1 FROM hdr) GROUP BY ALL""")
def q_definitions(spark, folder):
    """Key links of the model that the report table can follow, with the values that use them."""
    rows = hdr(spark, folder).withColumn("primary_station_id", F.col("station_key").cast("string"))
    graph = default_graph()
    links = [fk for fk in graph.foreign_keys if fk.parent in graph and fk.field in rows.columns and fk.table != "uncertainty_table"]
    counted = rows.agg(*[F.count(F.col(fk.field)).alias(f"v{i}") for i, fk in enumerate(links)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(fk.table).alias("child"), F.lit(fk.field).alias("field"), F.lit(fk.parent).alias("parent"),
                 F.lit(fk.parent_field).alias("parent_field"), F.lit(1).alias("depth"), F.col(f"v{i}").alias("n_values"))
        for i, fk in enumerate(links)])))


@query("""SELECT r AS reader, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum
          FROM events CROSS JOIN (VALUES ('flat_parquet'), ('single_table')) AS t(r)
          WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY r""")
def q_reader_registry(spark, folder):
    source = SourceConfig(main_variables=(), data_table="events", rename={"ts": "report_timestamp"},
                          descriptions={"report_timestamp": Description("datetime64[ns]")})
    start, end = ts("2024-01-05"), ts("2024-01-25")
    flat = DatasetConfig(name="events", sources={"events": source}, reader="flat_parquet")
    single = DatasetConfig(name="events", sources={"events": source}, reader={"events": "single_table"})
    path = f"{folder}/events.parquet"
    root = scratch_path(spark, "registry")
    table(spark, folder, "events").withColumnRenamed("ts", "report_timestamp").write.parquet(root)
    a = read_source(spark, flat, "events", start, end, input_path=root).withColumn("reader", F.lit("flat_parquet"))
    b = read_source(spark, single, "events", start, end, tables={"events": {"path": path}}).withColumn("reader", F.lit("single_table"))
    both = a.select("reader", "event_id").unionByName(b.select("reader", "event_id"))
    return both.groupBy("reader").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))


@query("""SELECT f AS format, count(*) AS n_rows, CAST(sum(observation_id) AS BIGINT) AS id_sum, min(report_timestamp) AS first_time,
            max(report_timestamp) AS last_time, max(observation_value) AS max_value
          FROM obs CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) AS t(f) GROUP BY f""")
def q_flat_export(spark, folder):
    rows = obs(spark, folder)
    root, parts = scratch_path(spark, "export"), []
    for fmt in ("csv", "json", "parquet"):
        export_flat(rows, f"{root}/{fmt}", fmt, "snappy" if fmt == "parquet" else "gzip")
        reader = spark.read.schema(rows.schema)
        back = reader.option("header", True).csv(f"{root}/{fmt}") if fmt == "csv" else reader.format(fmt).load(f"{root}/{fmt}")
        parts.append(back.withColumn("format", F.lit(fmt)))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("format").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("observation_id").alias("id_sum"), F.min("report_timestamp").alias("first_time"),
        F.max("report_timestamp").alias("last_time"), F.max("observation_value").alias("max_value"))


@query("""SELECT observation_id, report_timestamp, observed_variable, observation_value FROM obs
          WHERE report_timestamp >= TIMESTAMP '2024-01-08' AND report_timestamp < TIMESTAMP '2024-01-15'""")
def q_csv_scan(spark, folder):
    path = scratch_path(spark, "csv")
    coded = encode_variables(obs(spark, folder), varcode(spark))
    coded.write.option("header", True).option("sep", "|").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    schema = ", ".join(f"`{n}` {t}" for n, t in coded.dtypes)
    rows = read_flat_csv(spark, path, ts("2024-01-08"), ts("2024-01-15"), varcode(spark), "|", schema)
    return rows.select("observation_id", "report_timestamp", "observed_variable", "observation_value")


@query("""SELECT s.primary_station_id, CAST(epoch(min(h.report_timestamp)) AS BIGINT) + 2208988800 AS record_start,
            CAST(epoch(max(h.report_timestamp)) AS BIGINT) + 2208988800 AS record_end, s.latitude, s.longitude
          FROM hdr h JOIN station s ON h.station_key = s.station_key GROUP BY ALL""")
def q_json_station_index(spark, folder):
    from stationtide.functions.times import to_seconds

    path = scratch_path(spark, "index")
    span = hdr(spark, folder).groupBy("station_key").agg(
        to_seconds(F.min("report_timestamp")).alias("record_start"), to_seconds(F.max("report_timestamp")).alias("record_end"))
    index = span.join(station(spark, folder), "station_key").select(
        "primary_station_id", "record_start", "record_end", "latitude", "longitude",
        F.col("country").cast("string").alias("country"), F.lit("").alias("file_path"))
    index.write.json(path)
    return read_station_index_lines(spark, path).drop("country", "file_path")




@query("""SELECT 'header_table' AS "table", 'primary_station_id' AS field, 'station_configuration' AS parent, 'primary_id' AS parent_field, count(*) AS n_values FROM placed
          UNION ALL SELECT 'header_table', 'station_record_number', 'station_configuration', 'record_number', count(*) FROM placed
          UNION ALL SELECT 'observations_table', 'report_id', 'header_table', 'report_id', count(*) FROM placed""")
def q_read_definitions(spark, folder):
    """Table definitions written as CSV files and read again: the links that the placed reports use, with their values."""
    path = scratch_path(spark, "definitions")
    for definition in default_graph().values():
        rows = literal_table(spark, [(c, pa.string()) for c in ("element_name", "kind", "external_table")], definition.rows)
        rows.coalesce(1).write.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(f"{path}/{definition.name}.csv")
    graph = read_definitions(spark, path)
    rows = placed_reports(spark, folder)
    links = graph.to_frame(spark).where(F.col("parent").isin(list(graph))).select("table", "field", "parent", "parent_field")
    counted = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns]).unpivot([], rows.columns, "field", "n_values")
    return links.where("table <> 'uncertainty_table'").join(counted, "field")


@query("""SELECT 'events' AS source, t.name, t.problem, (SELECT count(*) FROM obs) AS n_rows FROM (VALUES ('signup', 'main_variable'), ('not_a_field', 'field')) AS t(name, problem)""")
def q_config_problems(spark, folder):
    """Configured names that the model or the variable table lack, beside the rows that they would concern."""
    source = SourceConfig(main_variables=("click", "signup"), descriptions={
        "report_timestamp": Description("datetime64[ns]"), "click": Description("float64"), "signup": Description("float64"), "not_a_field": Description("float64")})
    config = DatasetConfig(name="events", sources={"events": source}, reader="flat_parquet", lat_tile_size=45, lon_tile_size=45)
    known = varcode(spark).where("name <> 'signup'")
    n = obs(spark, folder).agg(F.count(F.lit(1)).alias("n_rows"))
    return config_problems(spark, config, default_graph(), known).withColumn("k", F.lit(0)).join(n.withColumn("k", F.lit(0)), "k").drop("k")


@query("""SELECT 'primary_station_id' AS field, count(*) AS n_rows FROM obs""")
def q_stored_fields(spark, folder):
    """Declared fields that stored rows lack."""
    rows = obs(spark, folder).drop("primary_station_id")
    source = SourceConfig(main_variables=("click",), descriptions={
        "report_timestamp": Description("datetime64[ns]"), "primary_station_id": Description("object"), "click": Description("float64")})
    missing = name_table(spark, "field", stored_field_report(rows, source)).withColumn("k", F.lit(0))
    return missing.join(rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("k", F.lit(0)), "k").drop("k")
