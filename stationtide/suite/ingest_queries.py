"""Whole ingestions: dry run, incremental, streaming."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from stationtide.model.definitions import default_graph
from stationtide.model.literals import literal_table
from stationtide.operators.joins import join_header_and_data
from stationtide.operators.tiling import assign_tiles
from stationtide.operators.catalogue import tile_status
from stationtide.operators.dedupe import count_different
from stationtide.plans.ingest import commit_run, compact, dry_run, ingest, ingest_declared, make_cdm, observations_of
from stationtide.plans.products import statistics
from stationtide.plans.retrieve import Request, retrieve_stored
from stationtide.plans.sanity import sanity_run
from stationtide.session import scratch_path
from stationtide.sources.registry import read_source
from stationtide.sources.store import files_of, new_run, read_catalogue, read_files, read_listed_tiles, write_tiles
from stationtide.streaming.incremental import open_file_stream, read_stream_catalogue, read_stream_tiles, stream_tiles
from stationtide.functions.times import ts
from stationtide.suite.registry import query
from stationtide.suite.views import REPORTS, obs, placed_reports, raw_report_tables, table, versions_of

_SOURCE = "ship_and_land"


def _raw(spark, folder):
    header, data = raw_report_tables(spark, folder)
    return read_source(spark, REPORTS, _SOURCE, ts("1990-01-01"), ts("2010-01-01"),
                       tables={"orders": {"frame": header}, "lineitem": {"frame": data}})


_LONG = """SELECT concat(w.l_orderkey, '-', w.l_linenumber, '.0-', w.l_partkey, '-', w.l_suppkey, '-', v) AS observation_id, w.l_orderkey AS report_id,
    p.primary_station_id, p.latitude, p.longitude, p.report_timestamp, v AS observed_variable,
    CASE v WHEN 'quantity' THEN l_quantity WHEN 'price' THEN l_extendedprice * 100 WHEN 'discount' THEN l_discount ELSE l_tax END AS observation_value,
    CASE WHEN v = 'price' THEN 'cent' ELSE '1' END AS units, CASE WHEN v = 'price' THEN 'euro' ELSE '1' END AS original_units,
    CASE WHEN v = 'price' AND l_returnflag = 'A' THEN 0 WHEN v = 'price' AND l_returnflag = 'R' THEN 1 ELSE 3 END AS quality_flag,
    CASE WHEN v = 'price' THEN 'cent' ELSE 'NA' END AS uncertainty_units5
    FROM lineitem w JOIN placed p ON w.l_orderkey = p.report_id CROSS JOIN (VALUES ('quantity'), ('price'), ('discount'), ('tax')) AS t(v)"""

_TILES = f"""SELECT concat('reports/reports_1.0.0_ship_and_land_', year(report_timestamp), '_',
      CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT), '.0_', CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT), '.0.parquet') AS asset,
    count(*) AS n_obs, count(DISTINCT primary_station_id) AS n_stations FROM ({_LONG}) GROUP BY 1"""


@query(_LONG)
def q_homogenise_reports(spark, folder):
    """Raw header and data tables to homogenised long observations."""
    rows = observations_of(_raw(spark, folder), REPORTS, _SOURCE)
    return rows.select("observation_id", "report_id", "primary_station_id", "latitude", "longitude", "report_timestamp",
                       "observed_variable", "observation_value", "units", "original_units",
                       F.col("quality_flag").cast("int").alias("quality_flag"), "uncertainty_units5")


@query(_TILES)
def q_make_cdm(spark, folder):
    """The catalogue an ingestion would produce."""
    entries = dry_run(_raw(spark, folder), REPORTS, _SOURCE, "1.0.0")
    return entries.select("asset", "n_obs", F.size("stations").cast("bigint").alias("n_stations"))


@query(_TILES)
def q_incremental_ingest(spark, folder):
    """Ingest until 1998, then everything: the second run adds the missing years, a third adds nothing."""
    root = scratch_path(spark, "ingest")
    raw = _raw(spark, folder)
    ingest(spark, raw.where(F.col("obs_date") < ts("1998-01-01")), REPORTS, _SOURCE, "1.0.0", root)
    ingest(spark, raw, REPORTS, _SOURCE, "1.0.0", root)
    ingest(spark, raw, REPORTS, _SOURCE, "1.0.0", root)
    return read_catalogue(spark, root).select("asset", "n_obs", F.size("stations").cast("bigint").alias("n_stations"))


@query(f"""SELECT observed_variable, count(*) AS n_rows, count(DISTINCT primary_station_id) AS n_stations, min(observation_value) AS min_value,
             max(observation_value) AS max_value FROM ({_LONG}) WHERE year(report_timestamp) = 1997 AND latitude >= 0 AND latitude < 90 GROUP BY 1""")
def q_ingest_then_read(spark, folder):
    """Stored tiles of one year and one latitude band, read back through their partition keys."""
    root = scratch_path(spark, "reread")
    ingest(spark, _raw(spark, folder), REPORTS, _SOURCE, "1.0.0", root)
    rows = read_listed_tiles(spark, root).where((F.year("time_start") == 1997) & (F.col("lat_start") == 0))
    return rows.groupBy("observed_variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("primary_station_id").alias("n_stations"),
        F.min("observation_value").alias("min_value"), F.max("observation_value").alias("max_value"))


@query(_TILES)
def q_stream_ingest(spark, folder):
    """The same ingestion from a file stream; the catalogue equals the batch one."""
    root = scratch_path(spark, "stream")
    header, _ = raw_report_tables(spark, folder)
    header = header.withColumnsRenamed({"o_orderkey": "report_id"})
    raw = open_file_stream(spark, f"{folder}/lineitem.parquet*", table(spark, folder, "lineitem").schema)

    def with_header(batch):
        flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1)
        lines = batch.withColumns({"flag": flag, "spread": F.col("l_tax")}).withColumnsRenamed({"l_orderkey": "report_id"})
        return join_header_and_data(header, lines)

    stream_tiles(raw, REPORTS, _SOURCE, "1.0.0", root, with_header).awaitTermination()
    entries = read_stream_catalogue(spark, root, "year")
    return entries.select("asset", "n_obs", F.size("stations").cast("bigint").alias("n_stations"))


@query(f"""SELECT observed_variable, count(*) AS n_rows, max(observation_value) AS max_value FROM ({_LONG}) GROUP BY 1""")
def q_stream_rows(spark, folder):
    """Rows stored by the stream, per variable."""
    root = scratch_path(spark, "stream")
    header = placed_reports(spark, folder).select(
        "report_id", F.col("report_timestamp").alias("obs_date"), F.col("primary_station_id").alias("stn"),
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    raw = open_file_stream(spark, f"{folder}/lineitem.parquet*", table(spark, folder, "lineitem").schema)

    def with_header(batch):
        lines = batch.withColumns({"flag": F.lit(0), "spread": F.col("l_tax")}).withColumnsRenamed({"l_orderkey": "report_id"})
        return join_header_and_data(header, lines)

    stream_tiles(raw, REPORTS, _SOURCE, "1.0.0", root, with_header).awaitTermination()
    return read_stream_tiles(spark, root).groupBy("observed_variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("observation_value").alias("max_value"))


_TILE_COUNTS = f"""SELECT asset, sum(n_obs) AS n_obs FROM ({_TILES}) GROUP BY 1"""


@query(_TILE_COUNTS)
def q_late_rows_ingest(spark, folder):
    """Three ingestions: nothing, half of a year, everything. The second leaves a period half stored; no row is lost."""
    root = scratch_path(spark, "late")
    raw = _raw(spark, folder)
    for part in (raw.where("false"), raw.where(F.col("obs_date") < ts("1997-07-01")), raw):
        ingest(spark, part, REPORTS, _SOURCE, "1.0.0", root)
    return read_catalogue(spark, root).groupBy("asset").agg(F.sum("n_obs").alias("n_obs"))


def _ids_and_totals(rows):
    """Rows, different ids and the sum of the values of each variable."""
    totals = rows.groupBy("observed_variable").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("observation_value").alias("total"))
    ids = count_different(rows, ["observed_variable"], "observation_id").withColumnRenamed("observed_variable", "_variable")
    both = totals.join(ids, F.col("observed_variable").eqNullSafe(F.col("_variable")), "left")
    return both.select("observed_variable", "n_rows", F.coalesce("n_different", F.lit(0)).cast("bigint").alias("n_ids"), "total")


@query(f"""SELECT observed_variable, count(*) AS n_rows, count(DISTINCT observation_id) AS n_ids, sum(observation_value) AS total FROM ({_LONG}) GROUP BY 1""")
def q_late_rows_read(spark, folder):
    """The stored rows after a period came in two parts and then once more."""
    root = scratch_path(spark, "late")
    raw = _raw(spark, folder)
    for part in (raw.where(F.col("obs_date") < ts("1997-07-01")), raw.where(F.col("obs_date") >= ts("1997-06-01")), raw):
        ingest(spark, part, REPORTS, _SOURCE, "1.0.0", root)
    return _ids_and_totals(read_listed_tiles(spark, root))


@query("""SELECT o_orderstatus AS dataset_source, count(*) AS n_rows, count(CASE WHEN o_orderstatus = 'O' THEN nullif(o_orderkey % 3, 0) END) AS n_flags,
             count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS n_uncertainties
          FROM placed p JOIN orders o ON o.o_orderkey = p.report_id WHERE o_orderstatus IN ('O', 'F') GROUP BY 1""")
def q_unlike_sources(spark, folder):
    """Two sources with different columns in one store: each comes back with all of its own."""
    root = scratch_path(spark, "unlike")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("report_id"), F.nullif(F.col("o_orderkey") % 3, F.lit(0)).cast("smallint").alias("quality_flag"),
        F.col("o_totalprice").alias("uncertainty_value5"), F.col("o_orderstatus").alias("dataset_source"))
    rows = placed_reports(spark, folder).drop("station_key", "station_record_number", "dataset_source").join(orders, "report_id")
    rows = rows.withColumns({"dataset": F.lit("orders"), "version": F.lit("1.0.0")})
    for source, absent in (("O", "uncertainty_value5"), ("F", "quality_flag")):
        run = new_run()
        write_tiles(assign_tiles(rows.where(F.col("dataset_source") == source).drop(absent), 90, 180, "year"), root, run)
        commit_run(spark, root, run, "year")
    versions = versions_of(read_catalogue(spark, root))
    found = [retrieve_stored(spark, root, versions, "orders", Request(dataset_source=s), "year").withColumn("dataset_source", F.lit(s)) for s in ("O", "F")]
    both = found[0].unionByName(found[1], allowMissingColumns=True)
    return both.groupBy("dataset_source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("quality_flag").alias("n_flags"), F.count("uncertainty_value5").alias("n_uncertainties"))


@query(f"""SELECT concat(y.y, '-01-01') AS batch_start, concat(y.y + 1, '-01-01') AS batch_end,
            CASE WHEN n IS NULL THEN 'empty' WHEN y.y <= 1996 THEN 'stored' ELSE 'written' END AS status, coalesce(n, 0) AS n_obs
          FROM (SELECT unnest(generate_series(1996, 2003)) AS y) y
          LEFT JOIN (SELECT year(report_timestamp) AS y, count(*) AS n FROM ({_LONG}) GROUP BY 1) n ON n.y = y.y""")
def q_declared_ingest(spark, folder):
    """Two spans of declared yearly batches that overlap; the last years have no rows."""
    root = scratch_path(spark, "declared")
    raw = _raw(spark, folder)
    ingest_declared(spark, raw, REPORTS, _SOURCE, "1.0.0", root, 1994, 1996)
    report = ingest_declared(spark, raw, REPORTS, _SOURCE, "1.0.0", root, 1996, 2003)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return report.select(day("batch_start"), day("batch_end"), "status", "n_obs")


@query(f"""SELECT 'type' AS "check", t.item, (SELECT count(*) FROM ({_LONG})) AS n_rows FROM (VALUES ('observations_table.report_id'), ('header_table.report_id'),
            ('observations_table.observed_variable'), ('observations_table.units'), ('observations_table.original_units')) AS t(item)
          UNION ALL SELECT 'variable', observed_variable, count(*) FROM ({_LONG}) WHERE observed_variable IN ('discount', 'tax') GROUP BY 2
          UNION ALL SELECT 'units', 'price in cent', count(*) FROM ({_LONG}) WHERE observed_variable = 'price'""")
def q_make_cdm_checked(spark, folder):
    """Homogenise, save and validate the raw tables against the model and a code table that knows two of the variables."""
    codes = literal_table(spark, [("name", pa.string()), ("units", pa.string())], [("quantity", "1"), ("price", "euro")])
    return make_cdm(_raw(spark, folder), REPORTS, _SOURCE, default_graph(), codes, scratch_path(spark, "cdm"))


@query(f"""SELECT 'ship_and_land' AS source, 'retrieved' AS "check", count(*) AS n_rows FROM ({_LONG}) WHERE year(report_timestamp) = 1996
            AND month(report_timestamp) = 1 AND latitude >= -10 AND latitude < 80 AND longitude >= -170
          UNION ALL SELECT 'ship_and_land', c, 0 FROM (VALUES ('missing_in_storage'), ('time_outside'), ('time_null'), ('variable_null'), ('variable_unknown'),
            ('latitude_outside'), ('latitude_null'), ('longitude_outside'), ('longitude_null'), ('station_null')) AS t(c)""")
def q_sanity_store(spark, folder):
    """The routine checks over a store, its files and one retrieved month."""
    root = scratch_path(spark, "sanity")
    ingest(spark, _raw(spark, folder), REPORTS, _SOURCE, "1.0.0", root)
    return sanity_run(spark, root, REPORTS, versions_of(read_catalogue(spark, root)), 1996)


@query(_TILES.replace(f"FROM ({_LONG})", f"FROM ({_LONG}) WHERE report_timestamp < TIMESTAMP '1998-01-01'"))
def q_delta_ingest(spark, folder):
    """Everything before December 1997, then December alone: far fewer rows than the tiles hold, and all of them are kept."""
    root = scratch_path(spark, "delta")
    raw = _raw(spark, folder)
    december = F.col("obs_date") >= ts("1997-12-01")
    ingest(spark, raw.where(F.col("obs_date") < ts("1997-12-01")), REPORTS, _SOURCE, "1.0.0", root)
    ingest(spark, raw.where(december & (F.col("obs_date") < ts("1998-01-01"))), REPORTS, _SOURCE, "1.0.0", root)
    return read_catalogue(spark, root).select("asset", "n_obs", F.size("stations").cast("bigint").alias("n_stations"))


@query(f"""SELECT observed_variable, count(*) AS n_rows, count(DISTINCT observation_id) AS n_ids,
            sum(CASE WHEN observed_variable = 'quantity' AND report_id % 50 = 0 AND year(report_timestamp) = 1996 THEN observation_value + 1 ELSE observation_value END) AS total
          FROM ({_LONG}) WHERE year(report_timestamp) <= 1996 GROUP BY 1""")
def q_changed_rows(spark, folder):
    """As many rows as are stored, some with other values: the new ones take the place of the old ones."""
    root = scratch_path(spark, "changed")
    raw = _raw(spark, folder).where(F.col("obs_date") < ts("1997-01-01"))
    ingest(spark, raw, REPORTS, _SOURCE, "1.0.0", root)
    wrong = (F.col("report_id") % 50 == 0) & (F.year("obs_date") == 1996)
    again = raw.withColumn("l_quantity", F.when(wrong, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    ingest(spark, again, REPORTS, _SOURCE, "1.0.0", root, on_change="replace")
    return read_listed_tiles(spark, root).groupBy("observed_variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("observation_id").alias("n_ids"), F.sum("observation_value").alias("total"))


def _two_runs(spark, folder):
    """A store whose tiles of 1997 came in two runs."""
    root = scratch_path(spark, "two")
    raw = _raw(spark, folder)
    for part in (raw.where(F.col("obs_date") < ts("1997-07-01")), raw.where(F.col("obs_date") >= ts("1997-07-01"))):
        ingest(spark, part, REPORTS, _SOURCE, "1.0.0", root)
    return root, raw


@query(_TILES.replace("count(*) AS n_obs, count(DISTINCT primary_station_id) AS n_stations",
                      "'exists_identical' AS status, count(DISTINCT report_timestamp < TIMESTAMP '1997-07-01') AS n_runs"))
def q_status_of_two_runs(spark, folder):
    """Tiles whose rows came in two runs have one entry, and it is identical with that of all rows."""
    root, raw = _two_runs(spark, folder)
    stored = read_catalogue(spark, root)
    status = tile_status(dry_run(raw, REPORTS, _SOURCE, "1.0.0"), stored).select("asset", "status")
    return status.join(stored.select("asset", F.size("runs").alias("n_runs")), "asset")


@query(f"""SELECT 'number of partitions' AS metric, CAST(count(*) AS VARCHAR) AS "value" FROM ({_TILES})
          UNION ALL SELECT 'number of stations', CAST(count(DISTINCT primary_station_id) AS VARCHAR) FROM ({_LONG})
          UNION ALL SELECT 'version', '1.0.0' UNION ALL SELECT 'source', 'ship_and_land'""")
def q_statistics_of_two_runs(spark, folder):
    """Statistics count tiles, not the runs that brought them."""
    root, _ = _two_runs(spark, folder)
    return statistics(read_catalogue(spark, root)).where(F.col("metric").isin("number of partitions", "number of stations", "version", "source"))


@query("""SELECT observed_variable, count(*) AS n_rows, sum(observation_value) AS total, true AS fewer_files, 1 AS n_runs FROM obs GROUP BY 1""")
def q_compacted_store(spark, folder):
    """Five runs of small files over the same tiles, packed into one: the same rows from fewer files, and no entry names an old run."""
    root = scratch_path(spark, "packed")
    rows = obs(spark, folder).withColumns({"dataset": F.lit("events"), "version": F.lit("1.0.0"), "dataset_source": F.lit("events")})
    for k in range(5):
        run = new_run()
        part = rows.where(F.col("observation_id") % 5 == k)
        write_tiles(assign_tiles(part, 180, 360, "year"), root, run, {"dataset": "events", "version": "1.0.0", "dataset_source": "events"})
        commit_run(spark, root, run, "year")
    before = files_of(spark, root, read_catalogue(spark, root)).count()
    compact(spark, root, "year", keep_commits=4)
    entries = read_catalogue(spark, root)
    files = files_of(spark, root, entries)
    counted = files.agg((F.count(F.lit(1)) < before).alias("fewer_files"), F.count_distinct("run").cast("int").alias("n_runs"))
    kept = read_files(spark, root, files).groupBy("observed_variable").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("observation_value").alias("total"))
    return kept.join(F.broadcast(counted), F.col("n_rows") > 0)


@query(f"""SELECT observed_variable, count(*) AS n_rows, count(DISTINCT observation_id) AS n_ids, sum(observation_value) AS total FROM ({_LONG}) GROUP BY 1""")
def q_stream_overlap(spark, folder):
    """Three streamed files of which each repeats rows of the others: every row is stored once, as in a batch."""
    root, source = scratch_path(spark, "overlap"), scratch_path(spark, "overlap-in")
    header, _ = raw_report_tables(spark, folder)
    lines = table(spark, folder, "lineitem")
    for k in range(3):
        lines.where(F.col("l_orderkey") % 3 != k).coalesce(1).write.mode("append").parquet(source)
    raw = open_file_stream(spark, source, lines.schema, "*.parquet", files_per_batch=1)

    def with_header(batch):
        flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1)
        return join_header_and_data(header.withColumnsRenamed({"o_orderkey": "report_id"}),
                                    batch.withColumns({"flag": flag, "spread": F.col("l_tax")}).withColumnsRenamed({"l_orderkey": "report_id"}))

    stream_tiles(raw, REPORTS, _SOURCE, "1.0.0", root, with_header).awaitTermination()
    return _ids_and_totals(read_stream_tiles(spark, root))
