"""Wide measures -> long observations, with their auxiliary columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.config import AuxColumn, ConfigError, SourceConfig
from stationtide.functions.names import uncertainty_label
from stationtide.model.codes import uncertainty_code

# Codes meaning "missing".
QUALITY_FLAG_MISSING = 3
PROCESSING_LEVEL_MISSING = 6
UNITS_MISSING = "NA"


def melt(df: DataFrame, variables, key=()) -> DataFrame:
    """One row per (input row, variable); rows without a value are kept.

    A missing ``observation_id`` is built from the natural key and the variable,
    so a retried task or a rerun gives the same ids. The key is put together while
    there is one row for all variables.
    """
    variables = list(variables)
    values = df.withColumns({v: F.col(f"`{v}`").cast("double") for v in variables})
    given = "observation_id" in df.columns and "observation_id" not in variables
    if not given:
        values = values.withColumn("_natural_key", natural_key(key))
    ids = [c for c in values.columns if c not in variables]
    out = values.unpivot([F.col(f"`{c}`") for c in ids], variables, "observed_variable", "observation_value")
    if given:
        return out
    return out.withColumn("observation_id", F.concat_ws("-", "_natural_key", "observed_variable")).drop("_natural_key")


def natural_key(key) -> Column:
    """What an observation id starts with: the same for all variables of a row."""
    if not key:
        raise ConfigError("melting needs observation_id or a natural key (observation_key)")
    return F.concat_ws("-", *[_id_part(F.col(f"`{k}`").cast("string")) for k in key])


def _id_part(value: Column) -> Column:
    """Part of an id that can be told apart: null has its own mark, and the separator is escaped."""
    escaped = F.replace(F.replace(value, F.lit("~"), F.lit("~~")), F.lit("-"), F.lit("~-"))
    return F.coalesce(escaped, F.lit("~0"))


def align_uncertainty(df: DataFrame, uncertainty: dict[str, tuple[AuxColumn, ...]]) -> DataFrame:
    """``uncertainty_value/type/units<code>`` on every row, filled for the described variable."""
    out = _uncertainty_columns(uncertainty, F.col("observed_variable"))
    return df.withColumns(out).drop(*{c.name for columns in uncertainty.values() for c in columns}) if out else df


def _uncertainty_columns(uncertainty: dict[str, tuple[AuxColumn, ...]], variable: Column) -> dict[str, Column]:
    out = {}
    for kind, columns in uncertainty.items():
        code = uncertainty_code(uncertainty_label(kind))
        out[f"uncertainty_value{code}"] = _for_variable(columns, lambda c: F.col(f"`{c.name}`"), variable).cast("float")
        out[f"uncertainty_type{code}"] = F.lit(code).cast("smallint")
        out[f"uncertainty_units{code}"] = F.coalesce(
            _for_variable(columns, lambda c: F.lit(c.units), variable), F.lit(UNITS_MISSING)
        )
    return out


def align_code(df: DataFrame, name: str, columns: tuple[AuxColumn, ...], missing: int) -> DataFrame:
    """Integer column ``name``, taken per variable from its raw column, else ``missing``."""
    if not columns:
        return df
    return df.withColumn(name, _code_column(columns, missing, F.col("observed_variable"))).drop(*[c.name for c in columns if c.name != name])


def _code_column(columns: tuple[AuxColumn, ...], missing: int, variable: Column) -> Column:
    value = _for_variable(columns, lambda c: F.col(f"`{c.name}`").cast("int"), variable)
    return F.coalesce(value, F.lit(missing)).cast("smallint")


def _for_variable(columns: tuple[AuxColumn, ...], value, variable: Column) -> Column:
    """CASE over the variables; of two rules for one variable the later wins."""
    return reduce(
        lambda rest, c: F.when(variable == c.main_variable, value(c)).otherwise(rest),
        columns, F.lit(None),
    )


def columns_of_variable(df: DataFrame, source: SourceConfig, variable: str) -> dict[str, Column]:
    """The columns that :func:`melt_source` gives the row of ``variable``, as expressions over the row that is still wide."""
    out = {"observed_variable": F.lit(variable), "observation_value": F.col(f"`{variable}`").cast("double")}
    if "observation_id" not in df.columns:
        out["observation_id"] = F.concat_ws("-", natural_key(source.observation_key), F.lit(variable))
    out |= _uncertainty_columns(source.uncertainty, F.lit(variable))
    for name, columns, missing in (("quality_flag", source.quality_flag, QUALITY_FLAG_MISSING), ("processing_level", source.processing_level, PROCESSING_LEVEL_MISSING)):
        if columns:
            out[name] = _code_column(columns, missing, F.lit(variable))
    return out


def melt_source(df: DataFrame, source: SourceConfig) -> DataFrame:
    """Melt and align in one narrow stage: no shuffle."""
    out = melt(df, source.main_variables, source.observation_key)
    out = align_uncertainty(out, source.uncertainty)
    out = align_code(out, "quality_flag", source.quality_flag, QUALITY_FLAG_MISSING)
    return align_code(out, "processing_level", source.processing_level, PROCESSING_LEVEL_MISSING)
