"""Availability, constraints, catalogue products and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationtide.operators.availability import (
    availability, bitmap_size, bitmap_table, constraint_size, constraint_table, constraints_from_json, constraints_to_json, day_bitmaps, days_of, decode_constraints,
    encode_constraints, flat_constraints, from_parts, json_fragments, merge_constraints, narrow_availability, positions_of, wide_availability,
)
from stationtide.operators.factorise import compress, expand, request_set
from stationtide.operators.tiling import assign_tiles
from stationtide.plans.ingest import commit_run
from stationtide.plans.products import compressed_constraints, described_variables, form_choices, station_summary, statistics
from stationtide.plans.retrieve import Request, request_entries, retrieve_rows, retrieve_stored, write_result
from stationtide.session import cut_lineage, scratch_path
from stationtide.sources.store import new_run, read_catalogue, read_parts, write_json_product, write_tiles
from stationtide.suite.registry import query
from stationtide.suite.views import EVENTS, VARIABLES, catalogue, hdr, obs, placed_reports, station, stored_catalogue, versions_of


def _day(column):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


@query("""SELECT primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, observed_variable AS variable FROM obs GROUP BY ALL""")
def q_availability(spark, folder):
    return availability(obs(spark, folder)).select("station", _day("day"), "variable")


@query("""SELECT primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, bool_or(observed_variable = 'click') AS click,
            bool_or(observed_variable = 'error') AS error, bool_or(observed_variable = 'purchase') AS purchase,
            bool_or(observed_variable = 'signup') AS signup, bool_or(observed_variable = 'view') AS view FROM obs GROUP BY ALL""")
def q_constraints_wide(spark, folder):
    rows = availability(obs(spark, folder))
    wide = wide_availability(rows, sorted(VARIABLES))
    return wide.select("station", _day("day"), *sorted(VARIABLES))


@query("""SELECT primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, observed_variable AS variable FROM obs GROUP BY ALL""")
def q_constraints_stack(spark, folder):
    rows = availability(obs(spark, folder))
    names = sorted(VARIABLES)
    return narrow_availability(wide_availability(rows, names), names).select("station", _day("day"), "variable")


def _entry_rows(spark, folder):
    tiled = assign_tiles(obs(spark, folder), 90, 180)
    return availability(tiled, ["lat_start", "lon_start"])


@query("""SELECT CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS lat_start, CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lon_start,
            primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, observed_variable AS variable FROM obs GROUP BY ALL""")
def q_constraints_encode_decode(spark, folder):
    keys = ["lat_start", "lon_start"]
    encoded = cut_lineage(encode_constraints(_entry_rows(spark, folder), keys))
    return decode_constraints(encoded, keys).select(*keys, "station", _day("day"), "variable")


@query("""SELECT la AS lat_start, lo AS lon_start, n_positions * n_variables AS n_observations, n_cells, n_true FROM (
            SELECT CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS la, CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lo,
              CAST(count(DISTINCT (primary_station_id, CAST(report_timestamp AS DATE))) AS INT) AS n_positions,
              CAST(count(DISTINCT observed_variable) AS INT) AS n_variables,
              count(DISTINCT primary_station_id) * count(DISTINCT CAST(report_timestamp AS DATE)) AS n_cells,
              count(DISTINCT (primary_station_id, CAST(report_timestamp AS DATE))) FILTER (WHERE observed_variable = 'error') AS n_true FROM obs GROUP BY ALL)""")
def q_constraints_table(spark, folder):
    keys = ["lat_start", "lon_start"]
    encoded = cut_lineage(encode_constraints(_entry_rows(spark, folder), keys))
    cells = constraint_table(encoded, keys, ["error"]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("error")).alias("n_true"))
    return constraint_size(encoded, keys).join(cells, keys)


@query("""SELECT CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS lat_start, CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lon_start,
            primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, observed_variable AS variable FROM obs GROUP BY ALL""")
def q_constraints_bitmaps(spark, folder):
    """Availability as day bitmaps of each station and variable, and back."""
    keys = ["lat_start", "lon_start"]
    bitmaps = cut_lineage(day_bitmaps(_entry_rows(spark, folder), keys))
    return days_of(bitmaps, keys).select(*keys, "station", _day("day"), "variable")


_CELLS = """SELECT CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS la, CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lo,
            primary_station_id AS s, CAST(report_timestamp AS DATE) AS d, observed_variable AS v FROM obs GROUP BY ALL"""


@query(f"""SELECT * FROM (WITH c AS ({_CELLS}), r AS (SELECT la, lo, v, dense_rank() OVER (PARTITION BY la, lo ORDER BY s) - 1 AS i, dense_rank() OVER (PARTITION BY la, lo ORDER BY d) - 1 AS j FROM c),
            n AS (SELECT la, lo, count(DISTINCT d) AS n FROM c GROUP BY ALL)
          SELECT la AS lat_start, lo AS lon_start, v AS variable, i * n + j AS position FROM r JOIN n USING (la, lo))""")
def q_constraint_positions(spark, folder):
    """Positions of every entry and variable, a row for each."""
    keys = ["lat_start", "lon_start"]
    return positions_of(cut_lineage(day_bitmaps(_entry_rows(spark, folder), keys)), keys)


@query(f"""SELECT * FROM (WITH c AS ({_CELLS}), a AS (SELECT la, lo, count(DISTINCT s) * count(DISTINCT d) AS n_cells, count(DISTINCT (s, d)) * count(DISTINCT v) AS n_observations,
              count(DISTINCT (s, d)) FILTER (WHERE v = 'error') AS n_true FROM c GROUP BY ALL)
          SELECT la AS lat_start, lo AS lon_start, n_observations, n_cells, n_true FROM a)""")
def q_constraint_cells(spark, folder):
    """Size and full table of every entry, from the bitmaps."""
    keys = ["lat_start", "lon_start"]
    bitmaps = cut_lineage(day_bitmaps(_entry_rows(spark, folder), keys))
    cells = bitmap_table(bitmaps, keys, ["error"]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("error")).alias("n_true"))
    return bitmap_size(bitmaps, keys).join(cells, keys)


@query(f"""SELECT * FROM (WITH c AS ({_CELLS}), n AS (SELECT la, lo, count(DISTINCT s) AS ns, count(DISTINCT d) AS nd, count(DISTINCT (s, d, v)) AS nc FROM c GROUP BY ALL)
          SELECT la AS lat_start, lo AS lon_start, ns AS n_stations, nd AS n_days, nc AS n_positions FROM n)""")
def q_constraints_json_stream(spark, folder):
    """The JSON object of every entry in pieces that no task has to put together: its stations, days and positions are counted in the text."""
    keys = ["lat_start", "lon_start"]
    pieces = json_fragments(cut_lineage(day_bitmaps(_entry_rows(spark, folder), keys)), keys, 500)
    numbers = F.size(F.split(F.regexp_replace(F.regexp_extract("text", r"([0-9,]*)$", 1), "^,", ""), ","))
    return pieces.groupBy(*keys).agg(
        F.count_if(F.col("part") == 1).alias("n_stations"), F.count_if(F.col("part") == 3).alias("n_days"),
        F.sum(F.when(F.col("part") == 5, numbers)).alias("n_positions"))


def _report_rows(spark, folder):
    rows = placed_reports(spark, folder).withColumns({"source": F.col("dataset_source"), "version": F.lit("1.0.0")})
    return availability(rows, ["source", "version"])


@query("""SELECT strftime(report_timestamp, '%Y-%m-%d') AS time, dataset_source AS source, '1.0.0' AS version,
            bool_or(observed_variable = '1-URGENT') AS urgent, bool_or(observed_variable = '5-LOW') AS low FROM hdr GROUP BY ALL""")
def q_constraints_merge(spark, folder):
    merged = merge_constraints(_report_rows(spark, folder), ["1-URGENT", "5-LOW"])
    return merged.select(_day("time"), "source", "version", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))


@query("""SELECT DISTINCT dataset_source, '1.0.0' AS version, observed_variable AS variables, strftime(report_timestamp, '%Y') AS year,
            strftime(report_timestamp, '%m') AS month, strftime(report_timestamp, '%d') AS day FROM hdr""")
def q_constraints_flat(spark, folder):
    return flat_constraints(_report_rows(spark, folder))


@query("""SELECT DISTINCT observed_variable AS variables, strftime(report_timestamp, '%Y') AS year, strftime(report_timestamp, '%m') AS month,
            strftime(report_timestamp, '%d') AS day FROM obs""")
def q_constraints_compress_explode(spark, folder):
    rows = availability(obs(spark, folder).withColumns({"source": F.lit("events"), "version": F.lit("1.0.0")}), ["source", "version"])
    flat = flat_constraints(rows).select("variables", "year", "month", "day")
    return expand(compress(flat, ["variables", "year", "month", "day"]))


@query("""SELECT DISTINCT primary_station_id AS station, observed_variable AS variable, strftime(report_timestamp, '%Y-%m-%d') AS day FROM obs""")
def q_constraints_compress_stations(spark, folder):
    rows = availability(obs(spark, folder)).select("station", "variable", _day("day"))
    return expand(compress(rows, ["station", "variable", "day"]))


@query("""SELECT 'one_month' AS request_class, year, month, array_to_string(list_sort(list(DISTINCT v)), ',') AS variables, count(DISTINCT d) AS n_days FROM (
            SELECT observed_variable AS v, strftime(report_timestamp, '%Y') AS year, strftime(report_timestamp, '%m') AS month,
              strftime(report_timestamp, '%d') AS d FROM obs) GROUP BY year, month ORDER BY year, month LIMIT 33""")
def q_constraints_partial_explode(spark, folder):
    rows = availability(obs(spark, folder).withColumns({"source": F.lit("events"), "version": F.lit("1.0.0")}), ["source", "version"])
    boxes = compress(flat_constraints(rows).select("variables", "year", "month", "day"), ["variables", "year", "month", "day"])
    requests = request_set(boxes, ["variables", "day"], 33, "one_month")
    return requests.select("request_class", "year", "month",
                           F.concat_ws(",", F.array_sort(F.array_distinct("variables"))).alias("variables"),
                           F.size(F.array_distinct("day")).cast("bigint").alias("n_days"))


@query("""SELECT 'number of partitions' AS metric, CAST(count(*) AS VARCHAR) AS value FROM cat
          UNION ALL SELECT 'number of stations', CAST(count(DISTINCT s) AS VARCHAR) FROM (SELECT unnest(stations) AS s FROM cat)
          UNION ALL SELECT 'time coverage start', strftime(min(t0), '%Y-%m-%d') FROM cat
          UNION ALL SELECT 'time coverage end', strftime(max(t1), '%Y-%m-%d') FROM cat
          UNION ALL SELECT 'latitude coverage start', CAST(min(lat0) AS VARCHAR) FROM cat
          UNION ALL SELECT 'latitude coverage end', CAST(max(lat1) AS VARCHAR) FROM cat
          UNION ALL SELECT 'longitude coverage start', CAST(min(lon0) AS VARCHAR) FROM cat
          UNION ALL SELECT 'longitude coverage end', CAST(max(lon1) AS VARCHAR) FROM cat
          UNION ALL SELECT DISTINCT 'station', unnest(stations) FROM cat
          UNION ALL SELECT DISTINCT 'variable', unnest(variables) FROM cat
          UNION ALL SELECT DISTINCT 'source', dataset_source FROM cat
          UNION ALL SELECT DISTINCT 'version', version FROM cat""")
def q_stats_summary(spark, folder):
    # The size in bytes depends on the storage format, so it has no counterpart in SQL.
    return statistics(stored_catalogue(spark, folder)).where(F.col("metric") != "total size")


@query("""SELECT DISTINCT 'stations' AS widget, unnest(stations) AS value FROM cat
          UNION ALL SELECT DISTINCT 'variables', unnest(variables) FROM cat
          UNION ALL SELECT DISTINCT 'dataset_source', dataset_source FROM cat
          UNION ALL SELECT DISTINCT 'version', version FROM cat
          UNION ALL SELECT 'year', CAST(y AS VARCHAR) FROM (SELECT unnest(generate_series(year(min(t0)),
             year(max(t1)) - CASE WHEN month(max(t1)) = 1 AND day(max(t1)) = 1 THEN 1 ELSE 0 END)) AS y FROM cat)
          UNION ALL SELECT 'month', lpad(CAST(m AS VARCHAR), 2, '0') FROM generate_series(1, 12) AS g(m)
          UNION ALL SELECT 'day', lpad(CAST(d AS VARCHAR), 2, '0') FROM generate_series(1, 31) AS g(d)""")
def q_widgets(spark, folder):
    return form_choices(stored_catalogue(spark, folder))


@query("""SELECT DISTINCT primary_station_id AS station_id, longitude, latitude, dataset_source AS source FROM placed""")
def q_station_summary(spark, folder):
    return station_summary(placed_reports(spark, folder))


@query("""SELECT 'events' AS source, t.name, t.description, t.dtype, t.units, count(o.observation_id) AS n_observations
          FROM (VALUES ('report_timestamp', 'time of the report', 'datetime64[ns]', NULL), ('primary_station_id', 'station', 'object', NULL),
            ('click', 'click count', 'float64', 'cm'), ('view', 'views', 'float64', '1'), ('purchase', 'purchases', 'float64', 'K'),
            ('signup', 'signups', 'float64', '1'), ('error', 'errors', 'float64', '%')) AS t(name, description, dtype, units)
          LEFT JOIN obs o ON o.observed_variable = t.name GROUP BY ALL""")
def q_variables_meta(spark, folder):
    return described_variables(obs(spark, folder).withColumn("dataset_source", F.lit("events")), EVENTS)


_COLUMNS = "observation_id, report_id, primary_station_id, latitude, longitude, report_timestamp, observed_variable, observation_value"


@query(f"""SELECT {_COLUMNS} FROM obs WHERE latitude >= 0 AND longitude >= -60 AND longitude < 120
            AND report_timestamp >= TIMESTAMP '2024-01-08' AND report_timestamp < TIMESTAMP '2024-01-15' AND observed_variable IN ('click', 'error')""")
def q_retrieve_box(spark, folder):
    return retrieve_rows(obs(spark, folder), Request(
        latitude_coverage=(0.0, 90.0), longitude_coverage=(-60.0, 120.0), time_coverage=("2024-01-08", "2024-01-15"), variables=("click", "error")))


@query(f"""SELECT {_COLUMNS} FROM obs WHERE primary_station_id = '0-20000-0-42' AND report_timestamp >= TIMESTAMP '2024-01-01' AND report_timestamp < TIMESTAMP '2025-01-01'""")
def q_retrieve_station(spark, folder):
    return retrieve_rows(obs(spark, folder), Request(stations=("0-20000-0-42",), time_coverage=("2024-01-01", "2025-01-01")))


@query(f"""SELECT {_COLUMNS} FROM obs WHERE observed_variable IN ('view', 'signup') AND report_timestamp >= TIMESTAMP '2024-01-01' AND report_timestamp < TIMESTAMP '2024-02-01'""")
def q_retrieve_variable(spark, folder):
    return retrieve_rows(obs(spark, folder), Request(variables=("view", "signup"), year=(2024,), month=(1,)))


@query(f"""SELECT {_COLUMNS} FROM obs WHERE year(report_timestamp) = 2024 AND month(report_timestamp) = 1 AND day(report_timestamp) IN (3, 14, 29)
            AND observed_variable = 'purchase'""")
def q_retrieve_ymd(spark, folder):
    return retrieve_rows(obs(spark, folder), Request(variables=("purchase",), year=(2024,), month=(1,), day=(3, 14, 29)))


@query("""SELECT report_id, primary_station_id, latitude, longitude, report_timestamp, observed_variable, observation_value FROM placed
          WHERE dataset_source = 'O' AND latitude >= -45 AND latitude < 30 AND longitude >= 10 AND report_timestamp >= TIMESTAMP '1996-02-10'
            AND report_timestamp < TIMESTAMP '1998-03-05' AND observed_variable IN ('1-URGENT', '2-HIGH')""")
def q_retrieve_via_catalogue(spark, folder):
    """Store tiles, then retrieve through catalogue and partition pruning: equals a full scan."""
    root = scratch_path(spark, "retrieve")
    rows = placed_reports(spark, folder).drop("station_key", "station_record_number")
    version = F.when(F.col("dataset_source") == "O", "10.0.0").otherwise("2.0.0")
    tiled = assign_tiles(rows.withColumns({"dataset": F.lit("orders"), "version": version}), 90, 180, "year")
    run = new_run()
    write_tiles(tiled, root, run, {"dataset": "orders"})
    commit_run(spark, root, run, "year")
    entries = read_catalogue(spark, root)
    versions = versions_of(entries)
    request = Request(dataset_source="O", latitude_coverage=(-45.0, 30.0), longitude_coverage=(10.0, 180.0),
                      time_coverage=("1996-02-10", "1998-03-05"), variables=("1-URGENT", "2-HIGH"))
    return retrieve_stored(spark, root, versions, "orders", request, "year")


@query("""SELECT DISTINCT dataset_source, '1.0.0' AS version, observed_variable AS variables, strftime(report_timestamp, '%Y') AS year,
            strftime(report_timestamp, '%m') AS month, strftime(report_timestamp, '%d') AS day FROM hdr""")
def q_constraints_from_store(spark, folder):
    """Compressed constraints of a stored dataset, expanded again."""
    root = scratch_path(spark, "constraints")
    rows = placed_reports(spark, folder).drop("station_key", "station_record_number")
    run = new_run()
    write_tiles(assign_tiles(rows.withColumns({"dataset": F.lit("orders"), "version": F.lit("1.0.0")}), 90, 180, "year"),
                root, run, {"dataset": "orders", "version": "1.0.0"})
    commit_run(spark, root, run, "year")
    return expand(compressed_constraints(from_parts(read_parts(spark, root))))


@query("""SELECT asset FROM cat WHERE dataset_source = 'O' AND version = '10.0.0' AND lat0 < 30 AND lat1 >= -45 AND lon1 >= 10
          AND t0 < TIMESTAMP '1998-03-05' AND TIMESTAMP '1996-02-10' < t1 AND list_contains(variables, '1-URGENT')""")
def q_retrieve_entries(spark, folder):
    entries = catalogue(spark, folder)
    request = Request(dataset_source="O", latitude_coverage=(-45.0, 30.0), longitude_coverage=(10.0, 180.0),
                      time_coverage=("1996-02-10", "1998-03-05"), variables=("1-URGENT",))
    return request_entries(entries, versions_of(entries), "orders", request).select("asset")


@query("""SELECT h.observed_variable, s.country, count(*) AS n_reports FROM hdr h JOIN station s ON h.station_key = s.station_key
          WHERE year(h.report_timestamp) = 1996 AND month(h.report_timestamp) IN (1, 2) GROUP BY ALL""")
def q_retrieve_report_counts(spark, folder):
    rows = hdr(spark, folder).join(station(spark, folder), "station_key")
    wanted = rows.where(Request(year=(1996,), month=(1, 2)).row_condition())
    return wanted.groupBy("observed_variable", "country").agg(F.count(F.lit(1)).alias("n_reports"))


_CELLS = "SELECT DISTINCT observed_variable AS v, strftime(report_timestamp, '%Y-%m-%d') AS d FROM obs"


@query(f"""SELECT count(*) AS n_cells, count(*) AS n_covered,
            (SELECT count(DISTINCT vs) FROM (SELECT d, string_agg(v, ',' ORDER BY v) AS vs FROM ({_CELLS}) GROUP BY d)) AS n_boxes FROM ({_CELLS})""")
def q_constraints_boxes(spark, folder):
    """The boxes themselves: disjoint (as many cells as the product has), complete, and one for each list of variables that
    days have in common."""
    rows = availability(obs(spark, folder)).select(_day("day"), "variable").distinct()
    boxes = cut_lineage(compress(rows, ["day", "variable"]))
    sizes = boxes.agg(F.sum(F.size("day") * F.size("variable")).cast("bigint").alias("n_cells"), F.count(F.lit(1)).alias("n_boxes"))
    covered = expand(boxes).distinct().agg(F.count(F.lit(1)).alias("n_covered"))
    return sizes.withColumn("k", F.lit(0)).join(covered.withColumn("k", F.lit(0)), "k").drop("k")


@query("""SELECT CAST(floor((latitude + 90) / 90) * 90 - 90 AS INT) AS lat_start, CAST(floor((longitude + 180) / 180) * 180 - 180 AS INT) AS lon_start,
            primary_station_id AS station, strftime(report_timestamp, '%Y-%m-%d') AS day, observed_variable AS variable FROM obs GROUP BY ALL""")
def q_constraints_json(spark, folder):
    """Encoded constraints written as JSON lines, read back and decoded."""
    keys = ["lat_start", "lon_start"]
    encoded = encode_constraints(_entry_rows(spark, folder), keys)
    path = scratch_path(spark, "constraints")
    write_json_product(constraints_to_json(encoded, keys), path)
    back = constraints_from_json(spark.read.schema("lat_start int, lon_start int, json string").json(path), keys)
    return decode_constraints(back, keys).select(*keys, "station", _day("day"), "variable")


@query("""SELECT format, count(*) AS n_rows, sum(observation_id) AS id_sum, min(observation_value) AS min_value, max(observation_value) AS max_value
          FROM obs CROSS JOIN (VALUES ('csv'), ('netCDF')) AS t(format) WHERE observed_variable IN ('click', 'error') AND year(report_timestamp) = 2024 GROUP BY 1""")
def q_result_formats(spark, folder):
    """A retrieval written in both formats of a request and read again."""
    out = []
    for fmt in ("csv", "netCDF"):
        request, path = Request(variables=("click", "error"), year=(2024,), format=fmt), scratch_path(spark, "result")
        rows = retrieve_rows(obs(spark, folder), request)
        write_result(rows, request, path)
        back = spark.read.schema(rows.schema).option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
        out.append(back.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n_rows"), F.sum("observation_id").alias("id_sum"),
                            F.min("observation_value").alias("min_value"), F.max("observation_value").alias("max_value")))
    return out[0].unionByName(out[1])


@query("""SELECT DISTINCT primary_station_id AS station_id, longitude, latitude, dataset_source AS source FROM placed""")
def q_json_product(spark, folder):
    """A catalogue product written as JSON and read again."""
    path = scratch_path(spark, "product")
    product = station_summary(placed_reports(spark, folder))
    write_json_product(product, path)
    return spark.read.schema(product.schema).json(path)
