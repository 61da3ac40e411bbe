"""Code tables: code -> name, units, abbreviation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Code tables read when none are named.
DEFAULT_CODE_TABLES = ("crs", "station_type", "observed_variable", "units", "z_coordinate_type")

# Uncertainty kinds by code.
UNCERTAINTY_CODES = {
    1: "random",
    2: "systematic",
    3: "quasisystematic",
    4: "structured random",
    5: "total",
    6: "ozone partial pressure total uncertainty",
    7: "ozone partial pressure percentage uncertainty",
    8: "negative random",
    9: "positive random",
    10: "negative systematic",
    11: "positive systematic",
    12: "negative quasisystematic",
    13: "positive quasisystematic",
    14: "negative structured random",
    15: "positive structured random",
    16: "negative total",
    17: "positive total",
}


def read_code_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One code table: all strings, empty cells stay empty strings, ``#`` starts a comment.

    The first column is the code and is renamed ``code``.
    """
    frame = (
        spark.read.option("header", True).option("comment", "#").option("mode", "FAILFAST")
        .option("nullValue", "\u0000").option("emptyValue", "").csv(f"{folder}/{name}.csv")
    )
    return frame.withColumnRenamed(frame.columns[0], "code").na.fill("")


def read_code_tables(spark: SparkSession, folder: str, names=None) -> dict[str, DataFrame]:
    return {n: read_code_table(spark, folder, n) for n in (names or DEFAULT_CODE_TABLES)}


def uncertainty_code(label: str) -> int:
    matches = [code for code, name in UNCERTAINTY_CODES.items() if name == label]
    if not matches:
        raise ValueError(f"unknown uncertainty kind {label!r}")
    return matches[0]
