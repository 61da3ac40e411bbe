"""Flat files: one row per observation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.functions.intervals import within
from stationtide.operators.codes import decode_variables


def expand_template(template: str, dataset: str, source: str, months: list[tuple[int, int | None]]) -> list[str]:
    """File names of a batch list; ``{year}`` and ``{month}`` as plain numbers, ``{month:02d}`` padded."""
    return [template.format(dataset_name=dataset, source=source, year=y, month=m) for y, m in months]


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths (or globs) that match a file; a missing batch is an empty batch, not an error."""
    out = []
    for path in paths:
        try:
            spark.read.text(path)  # looks the path up, reads nothing
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out.append(path)
    return out


def without_zone(df: DataFrame) -> DataFrame:
    """All times are UTC, so zoned timestamps become zone-free."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.to_utc_timestamp(F.col(f"`{c}`"), F.current_timezone()).cast("timestamp_ntz") for c in zoned}) if zoned else df


def time_slice(df: DataFrame, start, end, time_column: str = "report_timestamp") -> DataFrame:
    return df.where(within(F.col(time_column), start, end))


def read_flat_parquet(spark: SparkSession, path, start, end, codes: DataFrame | None = None,
                      time_column: str = "report_timestamp") -> DataFrame:
    """Parquet file(s) or glob, limited to ``[start, end)`` in the scan, variable codes decoded."""
    paths = [path] if isinstance(path, str) else list(path)
    df = time_slice(spark.read.parquet(*paths), start, end, time_column)
    return without_zone(decode_variables(df, codes) if codes is not None else df)


def read_flat_csv(spark: SparkSession, path, start, end, codes: DataFrame | None = None, separator: str = ",",
                  schema: str | None = None, time_column: str = "report_timestamp") -> DataFrame:
    """Delimited text with a header row. Give a schema where the data is large: inference reads it twice."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("sep", separator)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = time_slice(without_zone(reader.csv(paths)), start, end, time_column)
    return decode_variables(df, codes) if codes is not None else df


def read_month_partitions(spark: SparkSession, root: str, start, end, time_column: str = "report_timestamp",
                          fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Files laid out as ``year=/month=`` directories; only the months of the period are opened."""
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema else reader
    month_index = F.col("year") * 12 + F.col("month")
    first = start.year * 12 + start.month
    last = end.year * 12 + end.month
    df = reader.load(root).where((month_index >= first) & (month_index <= last))
    return time_slice(df, start, end, time_column).drop("year", "month")
