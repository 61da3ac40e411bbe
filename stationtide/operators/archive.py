"""Corrections and selections for multi-table station archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationtide.functions.intervals import within
from stationtide.functions.names import is_ship

# Variable codes, unit codes and the gravity constant of the corrections.
HUMIDITY, HUMIDITY_UNITS, HUMIDITY_SCALE = 138, 300, 100.0
GEOPOTENTIAL, GEOPOTENTIAL_UNITS, GRAVITY = 117, 631, 9.80665
HUMIDITY_VARIABLES = (34, 137, 138, 39)
WIND_VARIABLES = (106, 107, 139, 140)
# Value columns that scale with the observation.
SCALED_COLUMNS = (
    "observation_value", "uncertainty_value1", "homogenisation_adjustment", "an_depar@body", "fg_depar@body",
    "fg_depar@offline",
)
# Columns never read from the large archive tables.
UNREAD_COLUMNS = (
    "index", "recordtimestamp", "string1", "string4", "type", "expver", "class", "stream", "report_status@hdr",
    "report_event1@hdr", "report_rdbflag@hdr", "lat@hdr", "lon@hdr", "lsm@modsurf", "orography@modsurf",
    "windspeed10m@modsurf", "vertco_reference_2@body", "ppcode@conv_body", "datum_anflag@body",
    "datum_status@body", "datum_event1@body", "datum_rdbflag@body", "qc_pge@body", "lsm@surfbody_feedback",
    "obs_error@errstat", "final_obs_error@errstat", "fg_error@errstat", "eda_spread@errstat",
    "processing_level", "location_method", "source_id", "crs", "original_units",
)
# Columns of one table that another table provides.
REPEATED_COLUMNS = {
    "header_table": ("station_name", "platform_sub_type", "platform_type", "station_type", "crs", "profile_id"),
    "station_configuration": ("station_automation", "latitude", "longitude"),
}
# Codes set on every archive row.
CONSTANTS = {
    "uncertainty_type1": 1, "quality_flag": 2, "homogenisation_method": 14, "report_meaning_of_timestamp": 1,
}


def read_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are never read and the string-dimension helpers."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in UNREAD_COLUMNS and "string" not in c])


def without_repeated(df: DataFrame, table: str) -> DataFrame:
    return df.drop(*REPEATED_COLUMNS.get(table, ()))


def fix_units(df: DataFrame) -> DataFrame:
    """Humidity to percent and geopotential to height, in every scaled column that exists."""
    variable = F.col("observed_variable")
    out = {}
    for name in SCALED_COLUMNS:
        if name not in df.columns:
            continue
        column = F.col(f"`{name}`")
        scaled = F.when(variable == HUMIDITY, column * HUMIDITY_SCALE)
        if name != "homogenisation_adjustment":
            scaled = scaled.when(variable == GEOPOTENTIAL, column / GRAVITY)
        out[name] = scaled.otherwise(column)
    for name in ("units", "uncertainty_units1"):
        if name in df.columns:
            out[name] = (
                F.when(variable == HUMIDITY, HUMIDITY_UNITS).when(variable == GEOPOTENTIAL, GEOPOTENTIAL_UNITS)
                .otherwise(F.col(name))
            )
    return df.withColumns(out)


def merge_bias(df: DataFrame) -> DataFrame:
    """One ``homogenisation_adjustment`` from the bias columns of the variable groups."""
    if "RISE_bias_estimate" not in df.columns:
        return df
    variable, value = F.col("observed_variable"), F.col("RISE_bias_estimate")
    for column, group in (("humidity_bias_estimate", HUMIDITY_VARIABLES), ("wind_bias_estimate", WIND_VARIABLES)):
        if column in df.columns:
            value = F.when(variable.isin(*group), F.col(column)).otherwise(value)
    return df.withColumn("homogenisation_adjustment", value).drop(
        "RISE_bias_estimate", "humidity_bias_estimate", "wind_bias_estimate"
    )


def fix_values(df: DataFrame) -> DataFrame:
    """Constants, profile id, merged bias; rows with the invalid variable code 0 go."""
    fixed = {name: F.lit(value) for name, value in CONSTANTS.items()}
    if "report_id" in df.columns:
        fixed["profile_id"] = F.col("report_id")
    return merge_bias(df.withColumns(fixed)).where(F.col("observed_variable") != 0)


def apply_displacement(df: DataFrame) -> DataFrame:
    """Measurement position and time = launch position and time + drift."""
    return df.withColumns({
        "latitude": F.col("latitude") + F.col("latd"), "longitude": F.col("longitude") + F.col("lond"),
        "date_time": F.col("date_time") + F.col("timed"),
    })


def in_box(box: tuple[float, float, float, float], lat: str = "latitude", lon: str = "longitude") -> Column:
    lon_start, lon_end, lat_start, lat_end = box
    return within(F.col(lon), lon_start, lon_end) & within(F.col(lat), lat_start, lat_end)


def batch_stations(stations: DataFrame, start, end, box) -> DataFrame:
    """Stations of a batch: active in it and inside its box. Ships move, so their box is not checked."""
    active = (F.col("record_start") < end) & (F.col("record_end") >= start)
    return stations.where(active & (is_ship(F.col("primary_station_id")) | in_box(box)))


def reports_in_batch(header: DataFrame, start, end, box) -> DataFrame:
    """Reports of the period inside the box; their observations follow by the inner join."""
    return header.where(within(F.col("report_timestamp"), start, end) & in_box(box))


def slice_bounds(df: DataFrame, position: str, time_column: str, start, end) -> DataFrame:
    """Per variable: first and last source position inside the period, and the row count."""
    return df.where(within(F.col(time_column), start, end)).groupBy("observed_variable").agg(
        F.min(position).alias("first_position"), F.max(position).alias("last_position"), F.count(F.lit(1)).alias("n_rows")
    )


def in_seconds(column: str, start, end) -> Column:
    """Times of a period as archives count them: up to its last whole second, 23:59:59 of the last day, which is included."""
    return (F.col(column) >= start) & (F.col(column) <= end - F.expr("interval 1 second"))


def record_intervals(index: DataFrame, start, end, file: str = "file") -> DataFrame:
    """(file, observed_variable, first, stop): the rows of each variable in the period, as a half-open range of positions.

    ``index`` (file, observed_variable, record_timestamp, position) has a row for each record of a table that is sorted by variable
    and date: its time and the position of its first row. A record ends where the next one of the file begins, whatever its
    variable; the last one has no end, and ``stop`` is null.
    """
    after = F.lead("position").over(Window.partitionBy(file).orderBy("position"))
    records = index.withColumn("_stop", after).where(in_seconds("record_timestamp", start, end))
    return records.groupBy(file, "observed_variable").agg(
        F.min("position").alias("first"), F.when(F.count("_stop") == F.count(F.lit(1)), F.max("_stop")).alias("stop"))


def rows_of_intervals(table: DataFrame, intervals: DataFrame, position=("file", "row")) -> DataFrame:
    """Rows of a sorted archive table inside the intervals of their file.

    The positions between the lowest and the highest one are a static predicate on the sorted position column, by which
    the scan leaves out row groups; the ranges of each file are then matched by a join on the file.
    """
    file, row = position
    span = intervals.agg(F.min("first").alias("a"), F.when(F.count("stop") == F.count(F.lit(1)), F.max("stop")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not span.n:
        return table.where("false")
    inside = F.col(row) >= span.a if span.b is None else (F.col(row) >= span.a) & (F.col(row) < span.b)
    ranges = intervals.select(F.col(file).alias("_file"), F.col("first").alias("_first"), F.col("stop").alias("_stop"))
    match = (F.col(file) == F.col("_file")) & (F.col(row) >= F.col("_first")) & (F.col("_stop").isNull() | (F.col(row) < F.col("_stop")))
    return table.where(inside).join(ranges, match, "left_semi")
