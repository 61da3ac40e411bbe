"""Readers by name, chosen per dataset or per source."""

from __future__ import annotations

from typing import Any, Callable, Protocol

from pyspark.sql import DataFrame, SparkSession

from stationtide.config import ConfigError, DatasetConfig
from stationtide.sources.flat import existing_paths, expand_template, read_flat_csv, read_flat_parquet, read_month_partitions
from stationtide.sources.tables import open_table, read_header_and_data, read_single_table


class Reader(Protocol):
    def __call__(self, spark: SparkSession, config: DatasetConfig, source: str, start, end, **options: Any) -> DataFrame: ...


_READERS: dict[str, Reader] = {}


def register_reader(name: str) -> Callable[[Reader], Reader]:
    def add(reader: Reader) -> Reader:
        _READERS[name] = reader
        return reader

    return add


def reader_names() -> list[str]:
    return sorted(_READERS)


def read_source(spark: SparkSession, config: DatasetConfig, source: str, start, end, **options) -> DataFrame:
    """Read one source of a dataset for ``[start, end)`` with its configured reader."""
    name = config.reader_of(source)
    if name not in _READERS:
        raise ConfigError(f"unknown reader {name!r}; known: {reader_names()}")
    return _READERS[name](spark, config, source, start, end, **{**config.reader_args, **options})


@register_reader("flat_parquet")
def _flat_parquet(spark, config, source, start, end, input_path, file_template=None, months=(), codes=None):
    return read_flat_parquet(spark, _paths(spark, config, source, input_path, file_template, months), start, end, codes)


@register_reader("flat_csv")
def _flat_csv(spark, config, source, start, end, input_path, file_template=None, months=(), codes=None, separator=",", schema=None):
    paths = _paths(spark, config, source, input_path, file_template, months)
    return read_flat_csv(spark, paths, start, end, codes, separator, schema)


@register_reader("month_partitions")
def _month_partitions(spark, config, source, start, end, input_path, fmt="parquet", schema=None):
    return read_month_partitions(spark, input_path, start, end, fmt=fmt, schema=schema)


@register_reader("single_table")
def _single_table(spark, config, source, start, end, tables):
    definition = config.sources[source]
    return read_single_table(open_table(spark, tables[definition.data_table]), definition, start, end)


@register_reader("header_and_data")
def _header_and_data(spark, config, source, start, end, tables, time_in_data=False):
    definition = config.sources[source]
    header = open_table(spark, tables[definition.header_table])
    return read_header_and_data(header, open_table(spark, tables[definition.data_table]), definition, start, end, time_in_data)


def _paths(spark, config, source, input_path, file_template, months):
    if file_template is None:
        return input_path
    names = expand_template(file_template, config.name, source, list(months))
    found = existing_paths(spark, [f"{input_path}/{n}" for n in names])
    if not found:
        raise FileNotFoundError(f"no input file for {source} in the requested batches")
    return found
