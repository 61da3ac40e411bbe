"""Relational sources: one table, or a header and a data table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.config import ConfigError, SourceConfig
from stationtide.functions.intervals import within
from stationtide.operators.homogenise import merged_types
from stationtide.operators.joins import data_of_period, join_header_and_data, prune_header


def open_table(spark: SparkSession, spec: dict) -> DataFrame:
    """A table from a spec: ``{"table": ...}``, ``{"format": "jdbc", "options": {...}}`` or a file path.

    With JDBC, give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that the read is parallel; filters are pushed down.
    """
    if "frame" in spec:
        return spec["frame"]
    if "table" in spec:
        return spark.table(spec["table"])
    reader = spark.read.format(spec.get("format", "parquet")).options(**spec.get("options", {}))
    return reader.load(spec["path"]) if "path" in spec else reader.load()


def read_single_table(table: DataFrame, source: SourceConfig, start, end, ordered: bool = False) -> DataFrame:
    """Rows of the period. Ordering is a global sort, so it is done only on request."""
    rows = table.where(within(F.col(source.raw_time_column), start, end))
    if not ordered:
        return rows
    keys = ["id"] if "id" in table.columns else list(source.order_by)
    if not keys:
        raise ConfigError("ordered reads need an id column or order_by")
    return rows.orderBy(*keys)


def read_header_and_data(header: DataFrame, data: DataFrame, source: SourceConfig, start, end,
                         time_in_data: bool = False) -> DataFrame:
    """Two tables of one period, pruned and joined on the report id.

    The time filter goes to the table that has the time column. When only the
    header has it, the inner join itself restricts the data rows.
    """
    if not source.two_tables:
        raise ConfigError("this reader needs a header table")
    time_column = source.raw_time_column
    # Without a declared header time the filter is applied on the data side alone.
    if source.time_in_header or (not time_in_data and time_column in header.columns):
        header = header.where(within(F.col(time_column), start, end))
    if time_in_data and time_column in data.columns:
        data = data.where(within(F.col(time_column), start, end))
    dropped = source.conflicting_columns
    header = prune_header(header.drop(*dropped.get("header", ())), source.raw_header_columns())
    header = header.withColumnsRenamed({source.join_header: "report_id"})
    data = data.drop(*dropped.get("data", ())).withColumnsRenamed({"id": "observation_id", source.join_data: "report_id"})
    return join_header_and_data(header, data)


def restricted_data(header: DataFrame, data: DataFrame, source: SourceConfig, start, end) -> DataFrame:
    """Data rows alone, restricted by the header's time."""
    return data_of_period(data, header, source.raw_time_column, start, end, source.join_data, source.join_header)


def discovered_types(header: DataFrame, data: DataFrame) -> dict[str, str]:
    return merged_types(header, data)
