"""Raw columns -> observation-model columns, as one narrow projection."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationtide.config import DTYPES, SQL_TYPES, ConfigError, SourceConfig, SpaceColumns
from stationtide.model.literals import literal_table, name_table

# Type code of the vertical coordinate.
Z_TYPES = {"altitude": 0, "pressure": 1}
# Markers that replace nulls.
NULL_TEXT = "null"
NULL_INTEGER = -9999


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Raw -> model names; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_z_coordinate(df: DataFrame, space: SpaceColumns | None) -> DataFrame:
    """Copy the configured vertical column, so that the original can still be melted."""
    if "z_coordinate" in df.columns or space is None or space.z is None:
        return df
    if space.z not in Z_TYPES:
        raise ConfigError(f"vertical column {space.z!r} is not one of {sorted(Z_TYPES)}")
    return df.withColumns({"z_coordinate": F.col(space.z), "z_coordinate_type": F.lit(Z_TYPES[space.z])})


def missing_mandatory(df: DataFrame, source: SourceConfig) -> list[str]:
    """Mandatory columns that are absent; join ids do not count for two-table sources."""
    ids = {source.join_header, source.join_data} if source.two_tables else set()
    return sorted(set(source.mandatory) - ids - set(df.columns))


def mandatory_report(df: DataFrame, source: SourceConfig) -> DataFrame:
    """One row per mandatory column: is it there, and how many rows have a value."""
    ids = {source.join_header, source.join_data} if source.two_tables else set()
    wanted = [c for c in source.mandatory if c not in ids]
    present = [c for c in wanted if c in df.columns]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(present)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("n_values")) for i, c in enumerate(present)]
    pairs += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("bigint").alias("n_values"))
              for c in wanted if c not in present]
    return counted.select("n_rows", F.inline(F.array(*pairs))).select(
        "column", F.col("n_values").isNotNull().alias("present"),
        F.coalesce("n_values", F.lit(0)).alias("n_values"), "n_rows",
    )


def drop_listed(df: DataFrame, columns) -> DataFrame:
    return df.drop(*columns)


def cast_declared(df: DataFrame, source: SourceConfig) -> DataFrame:
    """Cast to the declared types. Text nulls become ``"null"``; null integers are an error."""
    out = {}
    for name, description in source.descriptions.items():
        if name in df.columns and description.dtype is not None:
            out[name] = _declared_cast(F.col(f"`{name}`"), name, DTYPES[description.dtype])
    return df.withColumns(out) if out else df


def _declared_cast(column: Column, name: str, target: str) -> Column:
    if target == "string":
        return F.coalesce(column.cast("string"), F.lit(NULL_TEXT))
    cast = column.cast(target)
    if target in ("tinyint", "smallint", "int", "bigint"):
        problem = F.raise_error(F.lit(f"null in integer column {name}")).cast(target)
        return F.when(column.isNull(), problem).otherwise(cast)
    return cast


def add_constants(df: DataFrame, constants: dict) -> DataFrame:
    """Constant columns; an existing column of the same name is overwritten."""
    return df.withColumns({n: F.lit(v) for n, v in constants.items()}) if constants else df


def cast_sql_types(df: DataFrame, sql_types: dict[str, str]) -> DataFrame:
    """Cast to the raw table's SQL types; null integers become -9999 first."""
    out = {}
    for name in df.columns:
        target = SQL_TYPES[sql_types[name]]
        column = F.col(f"`{name}`")
        out[name] = F.coalesce(column, F.lit(NULL_INTEGER)).cast(target) if target == "bigint" else column.cast(target)
    return df.withColumns(out)


def homogenise(df: DataFrame, source: SourceConfig, space: SpaceColumns | None = None) -> DataFrame:
    """Rename, derive the vertical coordinate, drop, cast and add constants, in this order."""
    out = rename_columns(df, source.rename)
    out = add_z_coordinate(out, source.space or space)
    out = drop_listed(out, source.columns_to_drop)
    out = cast_declared(out, source)
    return add_constants(out, source.add)


def select_model_columns(df: DataFrame, graph) -> DataFrame:
    """Model columns in model order; a column the model does not know is an error."""
    legal = graph.legal_fields
    unknown = sorted(set(df.columns) - set(legal))
    if unknown:
        raise ConfigError(
            f"these columns are not in the observation model: {unknown}; list them in columns_to_drop"
        )
    return df.select(*[F.col(f"`{c}`") for c in legal if c in df.columns])


def legal_field_report(df: DataFrame, graph) -> DataFrame:
    """Every column of the data: is it legal, which tables use it, how many rows have a value."""
    spark = df.sparkSession
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(df.columns)])
    values = counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("n_values")) for i, c in enumerate(df.columns)
    ])))
    legal = name_table(spark, "legal_name", graph.legal_fields)
    users = (
        graph.to_frame(spark).groupBy("field").agg(F.count(F.lit(1)).alias("n_tables"))
    )
    return (
        values.join(legal, values.column == legal.legal_name, "left")
        .join(users, values.column == users.field, "left")
        .select("column", "n_values", F.col("legal_name").isNotNull().alias("legal"),
                F.coalesce("n_tables", F.lit(0)).alias("n_tables"),
                F.column("column").isin(graph.ambiguous_fields).alias("ambiguous"))
    )


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns without any value, found by one aggregate over the data."""
    counts = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(f"v{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[i]]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def narrow_doubles(df: DataFrame) -> DataFrame:
    """Double columns as float."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.col(f"`{c}`").cast("float") for c in doubles}) if doubles else df


def schema_table(df: DataFrame, table: str) -> DataFrame:
    """(table, column, type) of a DataFrame, for schema reports."""
    text = pa.string()
    return literal_table(
        df.sparkSession, [("table", text), ("column", text), ("type", text)],
        [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields],
    )


def merged_types(header: DataFrame, data: DataFrame) -> dict[str, str]:
    """Column -> type of a two-table source; the header wins on shared names."""
    return {**dict(data.dtypes), **dict(header.dtypes)}
