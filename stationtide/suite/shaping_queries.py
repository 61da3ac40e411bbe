"""Homogenisation, melting, units and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationtide.config import AuxColumn, Description, SourceConfig, SpaceColumns
from stationtide.functions.times import from_seconds, to_seconds
from stationtide.model.definitions import default_graph
from stationtide.operators.codes import (
    backfill_units, decode_units, decode_variables, define_units, encode_variables, unknown_variables,
)
from stationtide.operators.dedupe import stack
from stationtide.operators.homogenise import (
    add_z_coordinate, cast_declared, cast_sql_types, drop_all_null, homogenise, mandatory_report, narrow_doubles,
    select_model_columns,
)
from stationtide.operators.reshape import align_code, align_uncertainty, melt
from stationtide.suite.registry import query
from stationtide.suite.views import EVENTS, MEASURES, hdr, obs, station, table, unit_codes, varcode, wide

_LINES = SourceConfig(
    main_variables=(), data_table="lineitem",
    rename={"l_orderkey": "report_id", "l_quantity": "quantity", "l_returnflag": "flag", "absent": "nowhere"},
    add={"report_type": 7, "flag_set": "x"},
    columns_to_drop=("l_linestatus", "not_there"),
    descriptions={"report_id": Description("object"), "quantity": Description("int64"), "flag": Description("object"),
                  "nowhere": Description("object")},
)


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS report_id, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
            l_returnflag AS flag, 7 AS report_type, 'x' AS flag_set FROM lineitem""")
def q_rename_cast_add(spark, folder):
    out = homogenise(table(spark, folder, "lineitem"), _LINES)
    return out.select("report_id", "l_linenumber", "quantity", "flag", "report_type", "flag_set")


@query("""SELECT coalesce(CAST(price_quality_flag AS BIGINT), -9999) AS flag,
            coalesce(CASE WHEN price_quality_flag = 0 THEN 'good' END, 'null') AS label, count(*) AS n_rows FROM wide GROUP BY ALL""")
def q_null_markers(spark, folder):
    rows = wide(spark, folder).select(
        F.col("price_quality_flag").alias("flag"), F.when(F.col("price_quality_flag") == 0, "good").alias("label"))
    typed = cast_sql_types(rows, {"flag": "integer", "label": "text"})
    source = SourceConfig(main_variables=(), descriptions={"label": Description("object")})
    return cast_declared(typed, source).groupBy("flag", "label").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT observation_id, report_id, observed_variable, observation_value, report_timestamp FROM obs""")
def q_cdm_select(spark, folder):
    rows = obs(spark, folder).select("report_timestamp", "observation_value", "observed_variable", "report_id", "observation_id")
    return select_model_columns(rows, default_graph())


@query("""SELECT h.report_id, h.dataset_source, w.level, w.price FROM hdr h JOIN wide w ON h.report_id = w.report_id""")
def q_drop_conflicts(spark, folder):
    from stationtide.functions.times import ts
    from stationtide.sources.tables import read_header_and_data

    source = SourceConfig(
        main_variables=(), header_table="h", data_table="d", join_header="key", join_data="line_key",
        header_columns=("dataset_source", "report_timestamp"), rename={"dataset_source": "dataset_source", "when": "report_timestamp"},
        descriptions={"report_timestamp": Description("datetime64[ns]"), "dataset_source": Description("object")},
        conflicting_columns={"data": ("idstation",), "header": ("date_of_observation",)},
    )
    header = hdr(spark, folder).select(
        F.col("report_id").alias("key"), "dataset_source", F.col("report_timestamp").alias("when"),
        F.lit("h").alias("idstation"), F.lit(1).alias("date_of_observation"))
    data = wide(spark, folder).select(
        F.col("report_id").alias("line_key"), "level", "price", F.lit("d").alias("idstation"), F.lit(2).alias("date_of_observation"))
    joined = read_header_and_data(header, data, source, ts("1990-01-01"), ts("2010-01-01"))
    return joined.select("report_id", "dataset_source", "level", "price")


@query("""SELECT c AS "column", p AS present, n AS n_values, n_rows FROM (
          SELECT count(*) AS n_rows, unnest([
            {'c': 'report_id', 'p': true, 'n': count(report_id)}, {'c': 'report_timestamp', 'p': true, 'n': count(report_timestamp)},
            {'c': 'observation_value', 'p': true, 'n': count(observation_value)}, {'c': 'units', 'p': false, 'n': CAST(0 AS BIGINT)}
          ], recursive := true) FROM hdr)""")
def q_mandatory_report(spark, folder):
    source = SourceConfig(main_variables=(), descriptions={}, mandatory=("report_id", "report_timestamp", "observation_value", "units"))
    return mandatory_report(hdr(spark, folder), source)


@query("""SELECT report_id, level, price AS pressure, price AS z_coordinate, 1 AS z_coordinate_type FROM wide""")
def q_z_coordinate(spark, folder):
    rows = wide(spark, folder).select("report_id", "level", F.col("price").alias("pressure"))
    return add_z_coordinate(rows, SpaceColumns("longitude", "latitude", "pressure"))


def _melted(spark, folder):
    return melt(wide(spark, folder), MEASURES, ("report_id", "level"))


@query("""SELECT report_id, level, observed_variable, observation_value,
            concat(report_id, '-', level, '-', observed_variable) AS observation_id FROM (
          SELECT report_id, level, 'quantity' AS observed_variable, quantity AS observation_value FROM wide
          UNION ALL SELECT report_id, level, 'price', price FROM wide
          UNION ALL SELECT report_id, level, 'discount', discount FROM wide
          UNION ALL SELECT report_id, level, 'tax', tax FROM wide)""")
def q_melt(spark, folder):
    return _melted(spark, folder).select("report_id", "level", "observed_variable", "observation_value", "observation_id")


@query("""SELECT 'quantity' AS observed_variable, count(*) AS n_rows, count(*) - count(quantity) AS n_null FROM wide
          UNION ALL SELECT 'price', count(*), count(*) - count(price) FROM wide
          UNION ALL SELECT 'discount', count(*), count(*) - count(discount) FROM wide
          UNION ALL SELECT 'tax', count(*), count(*) - count(tax) FROM wide""")
def q_melt_nulls_kept(spark, folder):
    return _melted(spark, folder).groupBy("observed_variable").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("observation_value").isNull()).alias("n_null"))


@query("""SELECT v AS observed_variable, 5 AS type_code, CASE WHEN v = 'price' THEN 'cent' ELSE 'NA' END AS units, count(*) AS n_rows,
            count(CASE WHEN v = 'price' THEN price_total_uncertainty END) AS n_values,
            max(CASE WHEN v = 'price' THEN CAST(CAST(price_total_uncertainty AS FLOAT) AS DOUBLE) END) AS max_value
          FROM wide CROSS JOIN (VALUES ('quantity'), ('price'), ('discount'), ('tax')) AS t(v) GROUP BY v""")
def q_uncertainty_align(spark, folder):
    out = align_uncertainty(_melted(spark, folder), {"total_uncertainty": (AuxColumn("price_total_uncertainty", "price", "cent"),)})
    return out.groupBy("observed_variable", F.col("uncertainty_type5").cast("int").alias("type_code"), F.col("uncertainty_units5").alias("units")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("uncertainty_value5").alias("n_values"),
        F.max(F.col("uncertainty_value5").cast("double")).alias("max_value"))


@query("""SELECT v AS observed_variable, CASE WHEN v = 'price' THEN coalesce(price_quality_flag, 3) ELSE 3 END AS quality_flag, count(*) AS n_rows
          FROM wide CROSS JOIN (VALUES ('quantity'), ('price'), ('discount'), ('tax')) AS t(v) GROUP BY ALL""")
def q_quality_flag(spark, folder):
    out = align_code(_melted(spark, folder), "quality_flag", (AuxColumn("price_quality_flag", "price"),), 3)
    return out.groupBy("observed_variable", F.col("quality_flag").cast("int").alias("quality_flag")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT v AS observed_variable, CASE WHEN v = 'tax' THEN level ELSE 6 END AS processing_level, count(*) AS n_rows
          FROM wide CROSS JOIN (VALUES ('quantity'), ('price'), ('discount'), ('tax')) AS t(v) GROUP BY ALL""")
def q_processing_level(spark, folder):
    rows = _melted(spark, folder).withColumn("tax_level", F.col("level"))
    out = align_code(rows, "processing_level", (AuxColumn("tax_level", "tax"),), 6)
    return out.groupBy("observed_variable", F.col("processing_level").cast("int").alias("processing_level")).agg(F.count(F.lit(1)).alias("n_rows"))


_UNITS = """CASE observed_variable WHEN 'click' THEN 'cm' WHEN 'purchase' THEN 'K' WHEN 'error' THEN '%' ELSE '1' END"""
_ORIGINAL = """CASE observed_variable WHEN 'click' THEN 'm' WHEN 'purchase' THEN 'degC' WHEN 'error' THEN '%' ELSE '1' END"""
_VALUE = """CASE observed_variable WHEN 'click' THEN observation_value * 100.0 WHEN 'purchase' THEN observation_value + CAST(273.15 AS DOUBLE) ELSE observation_value END"""


@query(f"""SELECT observation_id, observed_variable, {_UNITS} AS units, {_ORIGINAL} AS original_units FROM obs""")
def q_define_units(spark, folder):
    out = define_units(obs(spark, folder), EVENTS.sources["events"])
    return out.select("observation_id", "observed_variable", "units", "original_units")


@query(f"""SELECT observation_id, round({_VALUE}, 6) AS observation_value FROM obs""")
def q_unit_convert(spark, folder):
    out = define_units(obs(spark, folder), EVENTS.sources["events"])
    return out.select("observation_id", F.round("observation_value", 6).alias("observation_value"))


@query("""SELECT observed_variable, CASE observed_variable WHEN 'click' THEN 'm' WHEN 'purchase' THEN 'K' WHEN 'error' THEN '%' ELSE 'none' END AS units,
            count(*) AS n_rows FROM obs GROUP BY ALL""")
def q_unit_decode(spark, folder):
    code = F.when(F.col("observed_variable") == "click", 1).when(F.col("observed_variable") == "purchase", 5).when(
        F.col("observed_variable") == "error", 300).otherwise(0)
    out = decode_units(obs(spark, folder).withColumn("units", code), unit_codes(spark))
    return out.groupBy("observed_variable", "units").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT CASE WHEN observation_id % 2 = 0 THEN 'K' ELSE 'Pa' END AS units, count(*) AS n_rows FROM obs GROUP BY 1""")
def q_unit_backfill(spark, folder):
    # Even rows hold the old numeric code, odd rows were already fixed.
    rows = obs(spark, folder).withColumn("units", F.when(F.col("observation_id") % 2 == 0, "5").otherwise("Pa"))
    return backfill_units(rows, unit_codes(spark)).groupBy("units").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT observation_id, code AS observed_variable FROM obs JOIN varcode ON name = observed_variable""")
def q_var_encode(spark, folder):
    return encode_variables(obs(spark, folder), varcode(spark)).select("observation_id", "observed_variable")


@query("""SELECT observation_id, name AS observed_variable FROM (
            SELECT observation_id, CASE WHEN observation_id % 5 = 4 THEN 99 ELSE observation_id % 5 + 1 END AS c FROM obs) LEFT JOIN varcode ON code = c""")
def q_var_decode(spark, folder):
    rest = F.col("observation_id") % 5
    rows = obs(spark, folder).withColumn("observed_variable", F.when(rest == 4, 99).otherwise(rest + 1))
    return decode_variables(rows, varcode(spark)).select("observation_id", "observed_variable")


@query("""SELECT observed_variable, count(*) AS n_rows FROM hdr WHERE observed_variable NOT IN ('1-URGENT', '5-LOW') GROUP BY 1""")
def q_unknown_vars(spark, folder):
    known = varcode(spark).select("code", F.when(F.col("code") == 1, "1-URGENT").otherwise(" 5-LOW ").alias("name"))
    return unknown_variables(hdr(spark, folder), known)


@query("""SELECT observation_id, date_diff('second', TIMESTAMP '1900-01-01', date_trunc('second', report_timestamp)) AS seconds,
            CAST(date_trunc('second', report_timestamp) AS TIMESTAMP) AS restored FROM obs""")
def q_time_encode(spark, folder):
    coded = obs(spark, folder).withColumn("seconds", to_seconds(F.col("report_timestamp")))
    return coded.select("observation_id", "seconds", from_seconds(F.col("seconds")).alias("restored"))


@query("""SELECT report_id, level, price FROM wide""")
def q_all_null_drop(spark, folder):
    rows = wide(spark, folder).select("report_id", "level", "price", F.lit(None).cast("string").alias("empty"),
                                      F.when(F.col("level") > 1000, F.col("tax")).alias("never"))
    return drop_all_null(rows)


@query("""SELECT primary_station_id, CAST(country AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS observed_variable FROM station
          UNION ALL SELECT primary_station_id, NULL, observed_variable FROM obs""")
def q_union_by_name(spark, folder):
    left = station(spark, folder).select("primary_station_id", F.col("country").cast("string").alias("country"))
    return stack([left, obs(spark, folder).select("observed_variable", "primary_station_id")])


@query("""SELECT report_id, level, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price FROM wide""")
def q_narrow_floats(spark, folder):
    rows = narrow_doubles(wide(spark, folder).select("report_id", "level", "price"))
    return rows.withColumn("price", F.col("price").cast("double"))
