"""Data-quality checks. Each returns a report DataFrame from one pass over the rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationtide.functions.intervals import within
from stationtide.functions.names import follows_dataset_convention, is_version, underscored
from stationtide.model.definitions import TableGraph
from stationtide.model.literals import literal_table, name_table
from stationtide.model.mapping import field_sources

# Spark types that each declared kind accepts.
KIND_TYPES = {
    "int": ("smallint", "int", "bigint"),
    "numeric": ("smallint", "int", "bigint", "float", "double"),
    "varchar": ("string",),
    "timestamp": ("timestamp_ntz", "timestamp"),
    "timestamp with timezone": ("timestamp_ntz", "timestamp"),
    "int[]": ("array<int>",),
    "varchar[]": ("array<string>",),
    "bool": ("boolean",),
}


class CheckFailed(RuntimeError):
    """A check that must hold does not."""


def counts_as_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, n_rows) for each condition, counted in one aggregate."""
    counted = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return counted.unpivot([], list(checks), "check", "n_rows")


def outside_period(df: DataFrame, start, end, time_column: str = "report_timestamp") -> DataFrame:
    """Rows whose time is null or outside ``[start, end)``."""
    inside = F.coalesce(within(F.col(time_column), start, end), F.lit(False))
    return df.agg(F.count_if(~inside).alias("n_outside"), F.count(F.lit(1)).alias("n_rows"))


def assert_period(df: DataFrame, start, end, time_column: str = "report_timestamp") -> DataFrame:
    """Pass rows through and fail on one outside the period; costs no extra pass."""
    inside = F.coalesce(within(F.col(time_column), start, end), F.lit(False))
    problem = F.raise_error(F.concat(F.lit("time outside the batch: "), F.coalesce(F.col(time_column).cast("string"), F.lit("null"))))
    kind = df.schema[time_column].dataType
    return df.withColumn(time_column, F.when(inside, F.col(time_column)).otherwise(problem.cast(kind)))


def retrieved_report(df: DataFrame, start, end, lat_range, lon_range, variables) -> DataFrame:
    """Bounds, nulls and unknown variables of a retrieval result."""
    def outside(column: str, a, b) -> Column:
        return ~within(F.col(column), a, b)

    return counts_as_rows(df, {
        "time_outside": outside("report_timestamp", start, end),
        "time_null": F.col("report_timestamp").isNull(),
        "variable_null": F.col("observed_variable").isNull(),
        "variable_unknown": ~F.col("observed_variable").isin(list(variables)),
        "latitude_outside": outside("latitude", *lat_range),
        "latitude_null": F.col("latitude").isNull(),
        "longitude_outside": outside("longitude", *lon_range),
        "longitude_null": F.col("longitude").isNull(),
        "station_null": F.col("primary_station_id").isNull(),
    })


def field_mapping(df: DataFrame, graph: TableGraph) -> DataFrame:
    """Per table and field: how the data provides it (found, suffixed or foreign) and in which column."""
    return literal_table(
        df.sparkSession,
        [("table", pa.string()), ("field", pa.string()), ("column", pa.string()), ("how", pa.string())],
        field_sources(df.columns, graph),
    )


def _key_columns(df: DataFrame, graph: TableGraph) -> list[tuple]:
    """(table, key, column) of every primary key; the column is None where the data has none for it."""
    mapping = {(t, f): c for t, f, c, _ in reversed(field_sources(df.columns, graph))}
    return [(t, k, mapping.get((t, k))) for t, d in graph.items() for k in d.primary_keys]


def primary_key_report(df: DataFrame, graph: TableGraph) -> DataFrame:
    """Per primary key: availability and number of nulls, one aggregate for all keys."""
    keys = _key_columns(df, graph)
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"k{i}") for i, (_, _, c) in enumerate(keys) if c]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *nulls)
    rows = [
        F.struct(F.lit(t).alias("table"), F.lit(k).alias("field"), F.lit(c is not None).alias("available"),
                 (F.col(f"k{i}") if c else F.lit(0).cast("bigint")).alias("n_null"))
        for i, (t, k, c) in enumerate(keys)
    ]
    return counted.select("n_rows", F.inline(F.array(*rows)))


def assert_primary_keys(df: DataFrame, graph: TableGraph) -> None:
    broken = primary_key_report(df, graph).where(F.col("n_null") > 0).first()
    if broken is not None:
        raise CheckFailed(f"null in primary key {broken.field} of {broken.table}")


def _typed_columns(df: DataFrame, graph: TableGraph) -> list[tuple]:
    """(table, field, kind, type, conforms, column) of every found field."""
    types = dict(df.dtypes)
    rows = []
    for table, field, column, how in field_sources(df.columns, graph):
        if how != "foreign":
            kind = graph[table].kind(field)
            rows.append((table, field, kind, types[column], types[column] in KIND_TYPES[kind], column))
    return rows


def type_report(df: DataFrame, graph: TableGraph) -> DataFrame:
    """Declared kind against actual type of every found field, with the number of values it concerns."""
    rows = _typed_columns(df, graph)
    counted = df.agg(*[F.count(F.col(f"`{r[5]}`")).alias(f"v{i}") for i, r in enumerate(rows)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("table"), F.lit(f).alias("field"), F.lit(k).alias("kind"), F.lit(a).alias("type"),
                 F.lit(ok).alias("conforms"), F.col(f"v{i}").alias("n_values"))
        for i, (t, f, k, a, ok, _) in enumerate(rows)
    ])))


def ambiguous_columns(df: DataFrame, graph: TableGraph) -> DataFrame:
    """Columns that fit several tables, with their number of values."""
    names = [c for c in df.columns if c in graph.ambiguous_fields]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in names])
    return counted.unpivot(["n_rows"], names, "column", "n_values") if names else counted.select(
        "n_rows", F.lit(None).cast("string").alias("column"), F.lit(None).cast("bigint").alias("n_values")).where("false")


def unit_report(df: DataFrame, codes: DataFrame, units_column: str = "units") -> DataFrame:
    """Every (variable, units) of the data: is the variable known and are its units accepted."""
    found = df.groupBy("observed_variable", units_column).agg(F.count(F.lit(1)).alias("n_rows"))
    return _judged_units(found, codes, units_column).select("observed_variable", F.col(units_column).alias("units"), "n_rows", "status")


def _judged_units(found: DataFrame, codes: DataFrame, units_column: str) -> DataFrame:
    """Every (variable, units) with its ``status``."""
    accepted = codes.select(
        underscored(F.col("name")).alias("observed_variable"), F.col("units").alias(units_column)
    ).distinct().withColumn("_ok", F.lit(True))
    known = accepted.select("observed_variable").distinct().withColumn("_known", F.lit(True))
    joined = found.join(accepted, ["observed_variable", units_column], "left").join(known, "observed_variable", "left")
    status = F.when(F.col("_known").isNull(), "unknown_variable").when(F.col("_ok").isNull(), "different_units").otherwise("ok")
    return joined.withColumn("status", status)


def validation_report(df: DataFrame, graph: TableGraph, codes: DataFrame) -> DataFrame:
    """(check, item, n_rows): unknown columns, other types than declared, nulls in keys, unknown variables and units.

    The rows are read once: everything is counted per (variable, units), and these few counts are added up.
    """
    strange = [c for c in df.columns if c not in set(graph.legal_fields)]
    counts = [("type", f"{t}.{f}", F.count(F.col(f"`{c}`"))) for t, f, _, _, conforms, c in _typed_columns(df, graph) if not conforms]
    counts += [("primary_key", f"{t}.{k}", F.count_if(F.col(f"`{c}`").isNull())) for t, k, c in _key_columns(df, graph) if c]
    counts += [("unknown_column", c, F.count(F.col(f"`{c}`"))) for c in strange]
    found = df.groupBy("observed_variable", "units").agg(F.count(F.lit(1)).alias("n_rows"), *[n.alias(f"v{i}") for i, (_, _, n) in enumerate(counts)])

    variable, units, status = F.col("observed_variable"), F.col("units"), F.col("status")
    none = {c: F.lit(None).cast(df.schema[c].dataType) for c in ("observed_variable", "units")}

    def row(check: Column, item: Column, n: Column, a: Column, b: Column) -> Column:
        return F.struct(check.alias("check"), item.cast("string").alias("item"), n.alias("n"), a.alias("a"), b.alias("b"))

    of_units = row(F.when(status == "unknown_variable", "variable").when(status == "different_units", "units"),
                   F.when(status == "unknown_variable", variable.cast("string")).otherwise(F.concat_ws(" in ", variable, units)), F.col("n_rows"), variable, units)
    others = [row(F.lit(check), F.lit(item), F.col(f"v{i}"), *none.values()) for i, (check, item, _) in enumerate(counts)]
    parts = _judged_units(found, codes, "units").select(F.inline(F.array(of_units, *others))).where("check IS NOT NULL")
    # What is counted has a row also where the data has none.
    named = literal_table(df.sparkSession, [("check", pa.string()), ("item", pa.string())], [c[:2] for c in counts])
    parts = parts.unionByName(named.select("check", "item", F.lit(0).cast("bigint").alias("n"), none["observed_variable"].alias("a"), none["units"].alias("b")))
    # Of a variable there is one row for each of its units.
    summed = parts.groupBy("check", "item", "a", "b").agg(F.sum("n").alias("n_rows"))
    return summed.where("check <> 'primary_key' OR n_rows > 0").select("check", "item", "n_rows")


def schema_drift(df: DataFrame, described, variables_column: str = "observed_variable") -> DataFrame:
    """Columns and variables in the data but not described, and described but not in the data."""
    spark = df.sparkSession
    columns = name_table(spark, "name", [c for c in df.columns])
    found = columns.unionByName(df.select(F.col(variables_column).alias("name")).distinct()).distinct()
    declared = name_table(spark, "name", described)
    extra = found.join(declared, "name", "left_anti").withColumn("problem", F.lit("in_data_not_described"))
    absent = declared.join(found, "name", "left_anti").withColumn("problem", F.lit("described_not_in_data"))
    return extra.unionByName(absent)


def stored_field_report(df: DataFrame, source) -> list[str]:
    """Declared fields that stored tiles lack; main variables live in the melted columns."""
    expected = (set(source.descriptions) - set(source.main_variables)) | {"observation_value", "observed_variable"}
    return sorted(expected - set(df.columns))


def catalogue_row_problems(catalogue: DataFrame) -> DataFrame:
    """Rows that break the catalogue's own rules, counted per rule."""
    def bad_latitude(c: str) -> Column:
        return ~F.col(c).between(-90, 90)

    def bad_longitude(c: str) -> Column:
        return ~F.col(c).between(-180, 180)

    return counts_as_rows(catalogue, {
        "dataset_name": ~follows_dataset_convention(F.col("dataset")),
        "version": ~is_version(F.col("version")),
        "latitude": bad_latitude("latitude_coverage_start") | bad_latitude("latitude_coverage_end"),
        "longitude": bad_longitude("longitude_coverage_start") | bad_longitude("longitude_coverage_end"),
        "data_size": F.col("data_size") <= 0,
    })


def config_problems(spark, config, graph: TableGraph, known_variables: DataFrame) -> DataFrame:
    """Names in the configuration that neither the model nor the variable table know."""
    text = pa.string()
    variables = literal_table(spark, [("source", text), ("name", text)], [
        (s, v) for s, c in config.sources.items() for v in c.main_variables])
    fields = literal_table(spark, [("source", text), ("name", text)], [
        (s, d) for s, c in config.sources.items() for d in c.descriptions if d not in c.main_variables])
    names = known_variables.select(F.replace("name", F.lit(" "), F.lit("_")).alias("name"))
    legal = name_table(spark, "name", graph.legal_fields)
    return variables.join(names, "name", "left_anti").select("source", "name", F.lit("main_variable").alias("problem")).unionByName(
        fields.join(legal, "name", "left_anti").select("source", "name", F.lit("field").alias("problem"))
    )
