"""Lookups in code tables: variables and units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.config import ConfigError, SourceConfig
from stationtide.functions.names import underscored


def encode_variables(df: DataFrame, codes: DataFrame, column: str = "observed_variable") -> DataFrame:
    """Variable name -> integer code. Of duplicate names the last code counts; unknown names raise."""
    lookup = codes.groupBy(underscored(F.col("name")).alias("_name")).agg(
        F.max(F.col("code").cast("int")).alias("_code")
    )
    joined = df.join(lookup, F.col(column) == F.col("_name"), "left")
    unknown = F.raise_error(F.concat(F.lit("variable not in the code table: "), F.coalesce(F.col(column), F.lit("null"))))
    return joined.withColumn(column, F.coalesce(F.col("_code"), unknown.cast("int"))).drop("_name", "_code")


def one_per_code(lookup: DataFrame, code: str, name: str) -> DataFrame:
    """A lookup that cannot multiply rows: of several names of a code the last in order counts."""
    return lookup.groupBy(code).agg(F.max(name).alias(name))


def repeated_codes(lookup: DataFrame, code: str, name: str) -> DataFrame:
    """Codes with several different names: where the inverse mapping is not unique."""
    return lookup.groupBy(code).agg(F.array_sort(F.collect_set(name)).alias("names")).where(F.size("names") > 1)


def decode_variables(df: DataFrame, codes: DataFrame, column: str = "observed_variable") -> DataFrame:
    """Integer code -> variable name; unknown codes become null."""
    lookup = one_per_code(codes.select(F.col("code").cast("int").alias("_code"), underscored(F.col("name"), strip=False).alias("_name")), "_code", "_name")
    joined = df.join(lookup, F.col(column).cast("int") == F.col("_code"), "left")
    return joined.withColumn(column, F.col("_name")).drop("_name", "_code")


def unknown_variables(df: DataFrame, codes: DataFrame, column: str = "observed_variable") -> DataFrame:
    """Variables of the data that no code-table name matches, with their row counts."""
    names = codes.select(underscored(F.col("name")).alias(column))
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(names, column, "left_anti")


def listed_unit_rules(source: SourceConfig) -> list[tuple]:
    """(variable, units, original_units, scale, offset) of one source."""
    rows = []
    for name, description in source.descriptions.items():
        change = source.unit_changes.get(name)
        if change is None:
            rows.append((name, description.units, description.units, 1.0, 0.0))
            continue
        if change.target_units != description.units:
            raise ConfigError(
                f"new units {change.target_units!r} of {name} differ from the described units {description.units!r}"
            )
        rows.append((name, change.target_units, change.source_units, float(change.scale), float(change.offset)))
    return rows


def _of_rules(rules: list[tuple], i: int, kind: str, described: bool = False) -> Column:
    """Value ``i`` of the unit rule of a row's variable: a CASE over its distinct values, of which there are few.

    Null without a rule; where the variable is known to be ``described``, the most common value needs no comparison.
    """
    variables = {}
    for rule in rules:
        variables.setdefault(rule[i], []).append(rule[0])
    rest = max(variables, key=lambda v: len(variables[v]), default=None) if described else None
    return reduce(lambda out, v: F.when(F.col("observed_variable").isin(variables[v]), F.lit(v)).otherwise(out),
                  [v for v in variables if v != rest], F.lit(rest)).cast(kind)


def units_of_variable(source: SourceConfig, variable: str, value: Column) -> dict[str, Column]:
    """What :func:`define_units` gives a row of ``variable``; the variable must be described."""
    _, units, original, scale, offset = next(r for r in listed_unit_rules(source) if r[0] == variable)
    return {"observation_value": value * F.lit(scale) + F.lit(offset), "units": F.lit(units), "original_units": F.lit(original)}


def define_units(df: DataFrame, source: SourceConfig) -> DataFrame:
    """Set ``units`` and ``original_units`` and convert values where the source asks for it. The rules are part of the projection: no join."""
    rules = listed_unit_rules(source)
    kept = [c for c in df.columns if c not in ("units", "original_units", "observation_value")]
    undescribed = F.raise_error(F.concat(F.lit("variable is not described: "), F.coalesce("observed_variable", F.lit("null"))))
    value = F.when(
        F.col("observed_variable").isin([r[0] for r in rules]),
        F.col("observation_value") * _of_rules(rules, 3, "double", True) + _of_rules(rules, 4, "double", True),
    ).otherwise(undescribed.cast("double"))
    return df.select(
        *[F.col(f"`{c}`") for c in kept], value.alias("observation_value"),
        _of_rules(rules, 1, "string").alias("units"), _of_rules(rules, 2, "string").alias("original_units"),
    )


def integer_unit_columns(df: DataFrame) -> list[str]:
    integers = ("byte", "short", "integer", "long")
    return [f.name for f in df.schema.fields if "units" in f.name and f.dataType.typeName() in integers]


def decode_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Integer unit codes -> abbreviations; 0 is ``none`` and an unmapped code raises."""
    for i, name in enumerate(integer_unit_columns(df)):
        lookup = one_per_code(units.select(F.col("code").cast("bigint").alias(f"_c{i}"), F.col("abbreviation").alias(f"_u{i}")), f"_c{i}", f"_u{i}")
        code = F.col(f"`{name}`")
        unmapped = F.raise_error(F.concat(F.lit(f"unit code not mapped in {name}: "), F.coalesce(code.cast("string"), F.lit("null"))))
        decoded = F.when(code == 0, F.lit("none")).otherwise(F.coalesce(F.col(f"_u{i}"), unmapped.cast("string")))
        df = df.join(lookup, code.cast("bigint") == F.col(f"_c{i}"), "left").withColumn(name, decoded)
        df = df.drop(f"_c{i}", f"_u{i}")
    return df


def backfill_units(df: DataFrame, units: DataFrame, column: str = "units") -> DataFrame:
    """Rewrite stored numeric unit codes as names and leave rows that hold names alone."""
    lookup = one_per_code(units.select(F.col("code").cast("string").alias("_c"), F.col("abbreviation").alias("_u")), "_c", "_u")
    joined = df.join(lookup, F.col(column) == F.col("_c"), "left")
    is_code = F.col(column).rlike(r"^\d+$")
    missing = F.raise_error(F.concat(F.lit("unit code not mapped: "), F.col(column))).cast("string")
    fixed = F.when(is_code & (F.col(column) == "0"), F.lit("none")).when(
        is_code, F.coalesce(F.col("_u"), missing)
    ).otherwise(F.col(column))
    return joined.withColumn(column, fixed).drop("_c", "_u")
