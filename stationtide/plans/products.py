"""Catalogue products: statistics, form choices, stations, variables and constraints.

Products are rows, not single collected values, so a list of a million stations
stays distributed until it is written.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.config import DatasetConfig
from stationtide.functions.names import megabytes, zero_padded
from stationtide.model.literals import literal_table
from stationtide.operators.availability import flat_constraints
from stationtide.operators.factorise import compress


def statistics(catalogue: DataFrame) -> DataFrame:
    """(metric, value) rows: single figures and one row per listed station, variable, source and version."""
    def text(c):
        return F.date_format(c, "yyyy-MM-dd")

    def corner(c):
        return F.format_string("%.1f", c)

    figures = catalogue.agg(
        F.count(F.lit(1)).cast("string").alias("number of partitions"),
        F.concat(F.format_string("%.2f", megabytes(F.coalesce(F.sum("data_size"), F.lit(0)))), F.lit("MB")).alias("total size"),
        text(F.min("time_coverage_start")).alias("time coverage start"),
        text(F.max("time_coverage_end")).alias("time coverage end"),
        corner(F.min("latitude_coverage_start")).alias("latitude coverage start"),
        corner(F.max("latitude_coverage_end")).alias("latitude coverage end"),
        corner(F.min("longitude_coverage_start")).alias("longitude coverage start"),
        corner(F.max("longitude_coverage_end")).alias("longitude coverage end"),
    )
    figures = figures.unpivot([], figures.columns, "metric", "value")
    lists = listed_values(catalogue)
    totals = lists.where(F.col("metric") == "station").agg(
        F.lit("number of stations").alias("metric"), F.count(F.lit(1)).cast("string").alias("value")
    )
    return figures.unionByName(totals).unionByName(lists)


def listed_values(catalogue: DataFrame) -> DataFrame:
    """Distinct (metric, value) of stations, variables, sources and versions, in one shuffle."""
    each = catalogue.select(F.explode(F.concat(
        F.transform("stations", lambda s: F.struct(F.lit("station").alias("metric"), s.alias("value"))),
        F.transform("variables", lambda v: F.struct(F.lit("variable").alias("metric"), v.alias("value"))),
        F.array(F.struct(F.lit("source").alias("metric"), F.col("dataset_source").alias("value")),
                F.struct(F.lit("version").alias("metric"), F.col("version").alias("value"))),
    )).alias("e"))
    return each.select("e.metric", "e.value").distinct()


def form_choices(catalogue: DataFrame, variables=None) -> DataFrame:
    """(widget, value) rows of a request form.

    The last year is left out when the coverage ends on 1 January, because ends
    are exclusive. ``variables`` are the configured ones, if given.
    """
    spark = catalogue.sparkSession
    names = F.create_map(F.lit("station"), F.lit("stations"), F.lit("variable"), F.lit("variables"),
                         F.lit("source"), F.lit("dataset_source"), F.lit("version"), F.lit("version"))
    lists = listed_values(catalogue)
    if variables is not None:
        lists = lists.where(F.col("metric") != "variable")
    lists = lists.select(names[F.col("metric")].alias("widget"), "value")
    span = catalogue.agg(F.min("time_coverage_start").alias("a"), F.max("time_coverage_end").alias("b"))
    on_new_year = (F.month("b") == 1) & (F.dayofmonth("b") == 1)
    last = F.year("b") - F.when(on_new_year, 1).otherwise(0)
    years = span.where(F.col("a").isNotNull()).select(
        F.lit("year").alias("widget"), F.explode(F.sequence(F.year("a"), last)).alias("year")
    ).select("widget", F.col("year").cast("string").alias("value"))
    calendar = spark.range(1, 32).select(F.lit("day").alias("widget"), zero_padded(F.col("id"), 2).alias("value"))
    months = spark.range(1, 13).select(F.lit("month").alias("widget"), zero_padded(F.col("id"), 2).alias("value"))
    out = lists.unionByName(years).unionByName(months).unionByName(calendar)
    if variables is not None:
        text = pa.string()
        out = out.unionByName(literal_table(spark, [("widget", text), ("value", text)], [("variables", v) for v in sorted(set(variables))]))
    return out


def station_summary(tiles: DataFrame, source_column: str = "dataset_source") -> DataFrame:
    """Distinct (station, longitude, latitude, source)."""
    return tiles.select(
        F.col("primary_station_id").cast("string").alias("station_id"), "longitude", "latitude",
        F.col(source_column).alias("source"),
    ).distinct()


def variable_metadata(spark: SparkSession, config: DatasetConfig) -> DataFrame:
    """Descriptions per source, without disabled fields."""
    text = pa.string()
    rows = [
        (s, n, d.description, d.dtype, d.units)
        for s, c in config.sources.items() for n, d in c.descriptions.items() if n not in config.disabled_for(s)
    ]
    return literal_table(
        spark, [("source", text), ("name", text), ("description", text), ("dtype", text), ("units", text)], rows
    )


def described_variables(observations: DataFrame, config: DatasetConfig) -> DataFrame:
    """Variable metadata next to the number of stored observations of each variable."""
    counted = observations.groupBy(
        F.col("dataset_source").alias("source"), F.col("observed_variable").alias("name")
    ).agg(F.count(F.lit(1)).alias("n_observations"))
    described = variable_metadata(observations.sparkSession, config)
    return described.join(counted, ["source", "name"], "left").withColumn(
        "n_observations", F.coalesce("n_observations", F.lit(0))
    )


def compressed_constraints(rows: DataFrame) -> DataFrame:
    """Availability of all stations together, as boxes of value lists."""
    return compress(flat_constraints(rows), ["dataset_source", "version", "variables", "year", "month", "day"])


def largest_tile(catalogue: DataFrame) -> DataFrame:
    """The largest entry per (dataset, source), ties by asset."""
    return catalogue.groupBy("dataset", "dataset_source").agg(
        F.max_by(F.struct("asset", "data_size", "n_obs"), F.struct("data_size", "asset")).alias("_t")
    ).select("dataset", "dataset_source", "_t.*")
