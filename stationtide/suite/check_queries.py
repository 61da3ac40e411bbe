"""Quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationtide.functions.times import ts
from stationtide.model.definitions import default_graph
from stationtide.operators.joins import key_set_difference
from stationtide.operators.quality import (
    ambiguous_columns, catalogue_row_problems, field_mapping, outside_period, primary_key_report, retrieved_report,
    schema_drift, type_report, unit_report,
)
from stationtide.plans.retrieve import retrieve_rows
from stationtide.plans.sanity import routine_request, sanity_report, summary_check
from stationtide.suite.registry import query
from stationtide.suite.views import catalogue, hdr, obs, placed_reports, station, stored_catalogue, varcode, wide


@query("""SELECT c AS "check", n AS n_rows FROM (SELECT unnest([
            {'c': 'time_outside', 'n': count(*) FILTER (WHERE NOT (report_timestamp >= TIMESTAMP '2024-01-02' AND report_timestamp < TIMESTAMP '2024-01-30'))},
            {'c': 'time_null', 'n': CAST(0 AS BIGINT)},
            {'c': 'variable_null', 'n': count(*) FILTER (WHERE observed_variable = 'view')},
            {'c': 'variable_unknown', 'n': count(*) FILTER (WHERE observed_variable IN ('purchase', 'signup'))},
            {'c': 'latitude_outside', 'n': count(*) FILTER (WHERE NOT (latitude >= -80 AND latitude < 80))},
            {'c': 'latitude_null', 'n': CAST(0 AS BIGINT)},
            {'c': 'longitude_outside', 'n': count(*) FILTER (WHERE NOT (longitude >= -170 AND longitude < 170))},
            {'c': 'longitude_null', 'n': CAST(0 AS BIGINT)}, {'c': 'station_null', 'n': CAST(0 AS BIGINT)}], recursive := true) FROM obs)""")
def q_dq_bounds(spark, folder):
    rows = obs(spark, folder).withColumn("observed_variable", F.nullif("observed_variable", F.lit("view")))
    return retrieved_report(rows, ts("2024-01-02"), ts("2024-01-30"), (-80.0, 80.0), (-170.0, 170.0), ("click", "error"))


@query("""SELECT count(*) FILTER (WHERE report_timestamp < TIMESTAMP '1996-01-01' OR report_timestamp >= TIMESTAMP '2001-01-01') AS n_outside, count(*) AS n_rows FROM hdr""")
def q_dq_time_batch(spark, folder):
    return outside_period(hdr(spark, folder), ts("1996-01-01"), ts("2001-01-01"))


@query("""SELECT "table", field, available, n_null, (SELECT count(*) FROM wide) AS n_rows FROM (VALUES
            ('station_configuration', 'primary_id', false, 0), ('station_configuration', 'record_number', false, 0)) AS t("table", field, available, n_null)
          UNION ALL SELECT 'observations_table', 'observation_id', true, count(*) - count(tax), count(*) FROM wide
          UNION ALL SELECT 'header_table', 'report_id', true, 0, count(*) FROM wide
          UNION ALL SELECT 'uncertainty_table', 'observation_id', true, count(*) - count(tax), count(*) FROM wide
          UNION ALL SELECT 'uncertainty_table', 'uncertainty_type', false, 0, count(*) FROM wide
          UNION ALL SELECT 'sensor_configuration', 'sensor_id', false, 0, count(*) FROM wide""")
def q_dq_pk_null(spark, folder):
    rows = wide(spark, folder).select("report_id", F.col("tax").cast("string").alias("observation_id"), F.col("price").alias("observation_value"))
    return primary_key_report(rows, default_graph())


@query("""SELECT observed_variable, u AS units, count(*) AS n_rows, CASE WHEN name IS NULL THEN 'unknown_variable' WHEN u <> units THEN 'different_units' ELSE 'ok' END AS status
          FROM (SELECT CASE WHEN observed_variable = 'view' THEN 'sight' ELSE observed_variable END AS observed_variable,
                  CASE WHEN observed_variable = 'click' AND observation_id % 3 = 0 THEN 'm' WHEN observed_variable = 'purchase' THEN 'K' WHEN observed_variable = 'error' THEN '%' ELSE '1' END AS u FROM obs)
          LEFT JOIN varcode ON name = observed_variable GROUP BY ALL""")
def q_dq_units(spark, folder):
    name = F.col("observed_variable")
    units = F.when((name == "click") & (F.col("observation_id") % 3 == 0), "m").when(name == "purchase", "K").when(name == "error", "%").otherwise("1")
    rows = obs(spark, folder).withColumn("units", units).withColumn("observed_variable", F.when(name == "view", "sight").otherwise(name))
    return unit_report(rows, varcode(spark))


@query("""SELECT (SELECT count(*) FROM customer) AS n_left, (SELECT count(DISTINCT user_id) FROM events) AS n_right,
            (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)) AS only_left,
            (SELECT count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AS only_right""")
def q_dq_key_sets(spark, folder):
    return key_set_difference(station(spark, folder), obs(spark, folder), "primary_station_id", "primary_station_id")


@query("""SELECT name, problem FROM (SELECT DISTINCT observed_variable AS name, 'in_data_not_described' AS problem FROM obs WHERE observed_variable NOT IN ('click', 'view')
          UNION ALL SELECT c, 'in_data_not_described' FROM (VALUES ('latitude'), ('longitude'), ('report_id')) AS t(c)
          UNION ALL SELECT c, 'described_not_in_data' FROM (VALUES ('ozone'), ('agency')) AS t(c))""")
def q_dq_schema_drift(spark, folder):
    described = ["observation_id", "primary_station_id", "report_timestamp", "observed_variable", "observation_value", "click", "view", "ozone", "agency"]
    return schema_drift(obs(spark, folder), described)


@query("""SELECT c AS "check", n AS n_rows FROM (SELECT unnest([
            {'c': 'dataset_name', 'n': count(*) FILTER (WHERE dataset_source = 'P')}, {'c': 'version', 'n': count(*) FILTER (WHERE dataset_source = 'O')},
            {'c': 'latitude', 'n': CAST(0 AS BIGINT)}, {'c': 'longitude', 'n': count(*) FILTER (WHERE lon0 = 180)}, {'c': 'data_size', 'n': CAST(0 AS BIGINT)}], recursive := true) FROM cat)""")
def q_validation_report(spark, folder):
    entries = catalogue(spark, folder).withColumns({
        "dataset": F.when(F.col("dataset_source") == "P", "Bad Name").otherwise(F.col("dataset")),
        "version": F.when(F.col("dataset_source") == "O", "10").otherwise(F.col("version")),
        "longitude_coverage_end": F.when(F.col("longitude_coverage_start") == 180, 225.0).otherwise(F.col("longitude_coverage_end"))})
    return catalogue_row_problems(entries)


@query("""SELECT 'tiles' AS "check", true AS passed, count(*) AS n FROM cat
          UNION ALL SELECT 'stations', true, count(DISTINCT s) FROM (SELECT unnest(stations) AS s FROM cat)
          UNION ALL SELECT 'variables', false, 2""")
def q_summary_check(spark, folder):
    declared = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "6-NEVER"]
    return summary_check(stored_catalogue(spark, folder), declared)


@query("""SELECT 'missing_in_storage' AS "check", (SELECT count(*) FROM cat WHERE month(t0) = 3) AS n_rows
          UNION ALL SELECT 'retrieved', count(*) FROM placed WHERE dataset_source = 'F' AND year(report_timestamp) = 1996 AND month(report_timestamp) = 1
            AND latitude >= -10 AND latitude < 80 AND longitude >= -170 AND observed_variable IN ('1-URGENT', '2-HIGH')
          UNION ALL SELECT c, 0 FROM (VALUES ('time_outside'), ('time_null'), ('variable_null'), ('variable_unknown'), ('latitude_outside'), ('latitude_null'),
            ('longitude_outside'), ('longitude_null'), ('station_null')) AS t(c)""")
def q_sanity_run(spark, folder):
    entries = catalogue(spark, folder).select("asset", "time_coverage_start")
    stored = entries.where(F.month("time_coverage_start") != 3)
    variables = ("1-URGENT", "2-HIGH")
    rows = retrieve_rows(placed_reports(spark, folder), routine_request("F", 1996, variables))
    return sanity_report(entries, stored, rows, 1996, variables)


@query("""SELECT 'longitude' AS "column", count(*) AS n_values, count(*) AS n_rows FROM obs UNION ALL
          SELECT 'latitude', count(*) FILTER (WHERE latitude <> 0), count(*) FROM obs""")
def q_ambiguous_fields(spark, folder):
    rows = obs(spark, folder).withColumn("latitude", F.nullif("latitude", F.lit(0.0)))
    return ambiguous_columns(rows, default_graph()).select("column", "n_values", "n_rows")


@query("""SELECT t.a AS "table", t.b AS field, t.c AS kind, t.d AS type, t.e AS conforms, CASE WHEN t.b = 'observation_value' THEN n1 ELSE n2 END AS n_values
          FROM (SELECT count(observation_value) AS n1, count(*) AS n2 FROM (SELECT nullif(tax, 0.01) AS observation_value FROM wide))
          CROSS JOIN (VALUES ('observations_table', 'report_id', 'varchar', 'bigint', false), ('observations_table', 'observation_value', 'numeric', 'double', true),
            ('header_table', 'report_id', 'varchar', 'bigint', false), ('header_table', 'station_record_number', 'int', 'int', true)) AS t(a, b, c, d, e)
          WHERE t.b <> 'observation_value' UNION ALL
          SELECT 'observations_table', 'observation_value', 'numeric', 'double', true, count(tax) FROM wide""")
def q_dtype_report(spark, folder):
    rows = wide(spark, folder).select("report_id", F.col("level").alias("station_record_number"), F.col("tax").alias("observation_value"))
    return type_report(rows, default_graph())


@query("""SELECT t.a AS "table", t.b AS field, t.c AS "column", t.d AS how, CASE WHEN t.c = 'longitude' THEN n1 ELSE n2 END AS n_values
          FROM (SELECT count(nullif(longitude, 0)) AS n1, count(*) AS n2 FROM obs) CROSS JOIN (VALUES
            ('station_configuration', 'longitude', 'longitude', 'found'), ('station_configuration', 'primary_id', 'primary_station_id', 'foreign'),
            ('observations_table', 'observation_id', 'observation_id', 'found'), ('observations_table', 'report_id', 'report_id', 'found'),
            ('observations_table', 'observed_variable', 'observed_variable', 'found'), ('observations_table', 'observation_value', 'observation_value', 'found'),
            ('observations_table', 'longitude', 'longitude', 'found'), ('header_table', 'report_id', 'report_id', 'found'),
            ('header_table', 'report_timestamp', 'report_timestamp', 'found'), ('header_table', 'primary_station_id', 'primary_station_id', 'found'),
            ('header_table', 'longitude', 'longitude', 'found'), ('header_table', 'latitude', 'latitude|header_table', 'suffixed'),
            ('uncertainty_table', 'observation_id', 'observation_id', 'found')) AS t(a, b, c, d)""")
def q_field_mapping(spark, folder):
    """How each model field is provided by the data, next to its number of values."""
    rows = obs(spark, folder).withColumn("longitude", F.nullif("longitude", F.lit(0.0)))
    rows = rows.withColumnsRenamed({"latitude": "latitude|header_table"})
    counted = rows.agg(*[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(rows.columns)])
    values = counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("n_values")) for i, c in enumerate(rows.columns)])))
    return field_mapping(rows, default_graph()).join(values, "column")
