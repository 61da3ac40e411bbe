"""Small driver-side tables as DataFrames of exactly known size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, columns: list[tuple[str, pa.DataType]], rows) -> DataFrame:
    """DataFrame over configuration rows.

    Built from Arrow, so the plan holds a local relation with an exact size and
    Spark itself decides, by that size, whether a join may broadcast it.
    """
    rows = list(rows)
    arrays = [pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(columns)]
    return spark.createDataFrame(pa.table(dict(zip([n for n, _ in columns], arrays))))


def name_table(spark: SparkSession, column: str, names) -> DataFrame:
    return literal_table(spark, [(column, pa.string())], [(n,) for n in names])
