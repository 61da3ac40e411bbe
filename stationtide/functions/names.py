"""Names, codes and small text values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A dotted three-part version, with optional pre-release and build parts.
VERSION_PATTERN = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(-[0-9A-Za-z.-]+)?(\+[0-9A-Za-z.-]+)?$"


def underscored(name: Column, strip: bool = True) -> Column:
    """Variable name as used in column names: blanks become underscores."""
    return F.replace(F.trim(name) if strip else name, F.lit(" "), F.lit("_"))


def uncertainty_label(kind: str) -> str:
    """Config key such as ``structured_random_uncertainty`` -> code-table label."""
    return kind.replace("_uncertainty", "").replace("_", " ")


def zero_padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def is_ship(station_id: Column, marker: str = "0-20999-0") -> Column:
    return station_id.contains(marker)


def asset_bucket(asset: Column) -> Column:
    return F.element_at(F.split(asset, "/"), 1)


def asset_file(asset: Column) -> Column:
    return F.element_at(F.split(asset, "/"), -1)


def follows_dataset_convention(name: Column) -> Column:
    """Lower case with underscores instead of blanks, and not empty."""
    return (F.length(name) > 0) & (F.lower(F.replace(name, F.lit(" "), F.lit("_"))) == name)


def is_version(version: Column) -> Column:
    return version.rlike(VERSION_PATTERN)


def version_key(version: Column) -> Column:
    """Sortable key: numeric parts first, and a pre-release sorts below its release."""
    core = F.transform(
        F.split(F.regexp_extract(version, r"^(\d+\.\d+\.\d+)", 1), r"\."), lambda p: p.cast("int")
    )
    pre = F.regexp_extract(version, r"^[0-9.]+-([0-9A-Za-z.-]+)", 1)
    return F.struct(core.alias("core"), (pre == "").alias("released"), pre.alias("pre"))


def megabytes(n_bytes: Column) -> Column:
    return F.round(n_bytes / F.lit(1024.0 * 1024.0), 2)


def readable_size(n_bytes: Column) -> Column:
    """Largest unit below 1024, one decimal."""
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    out = F.format_string("%.1f%s", n_bytes / F.lit(1024.0**5), F.lit("PiB"))
    for power in reversed(range(len(units))):
        scaled = n_bytes / F.lit(1024.0**power)
        out = F.when(F.abs(scaled) < 1024, F.format_string("%.1f%s", scaled, F.lit(units[power]))).otherwise(out)
    return out
