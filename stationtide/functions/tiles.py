"""Tile arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stationtide.functions.intervals import LATITUDE_LIMIT, LONGITUDE_LIMIT


def latitude_tile(latitude: Column, size) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return (F.floor((latitude + 90) / size) * size - 90).cast("int")


def longitude_tile(longitude: Column, size) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return (F.floor((longitude + 180) / size) * size - 180).cast("int")


def latitude_tile_end(start: Column, size) -> Column:
    return F.least(start + size, F.lit(int(LATITUDE_LIMIT)))


def longitude_tile_end(start: Column, size) -> Column:
    return F.least(start + size, F.lit(int(LONGITUDE_LIMIT)))


def asset_name(
    dataset: Column, version: Column, source: Column, time_start: Column, time_size: str,
    lat_start: Column, lon_start: Column, extension: str = "parquet",
) -> Column:
    """``dataset/dataset_version_source_YYYYMM_lat_lon.ext`` with float tile corners."""
    stamp = F.date_format(time_start, "yyyyMM" if time_size == "month" else "yyyy")
    corner = lambda c: F.format_string("%.1f", c.cast("double"))
    file_name = F.concat_ws("_", dataset, version, source, stamp, corner(lat_start), corner(lon_start))
    return F.concat(dataset, F.lit("/"), file_name, F.lit("." + extension))


def per_year_size(sizes, source: Column, year: Column) -> Column:
    """Tile size that may depend on source, year period or both.

    ``sizes`` is an int, ``{period: int}``, ``{source: int}`` or
    ``{source: {period: int}}``; periods such as ``"2006-2010"`` include both
    ends and the first match wins. Rows matching none raise.
    """
    if isinstance(sizes, int):
        return F.lit(sizes)
    conditions: list[tuple[Column, int]] = []
    for key, value in sizes.items():
        if isinstance(value, dict):
            conditions += [((source == key) & _in_period(year, p), n) for p, n in value.items()]
        elif _is_period(key):
            conditions.append((_in_period(year, key), value))
        else:
            conditions.append((source == key, value))
    out = F.raise_error(F.concat(F.lit("no tile size for year "), year.cast("string"))).cast("int")
    for condition, size in reversed(conditions):
        out = F.when(condition, F.lit(size)).otherwise(out)
    return out


def _is_period(key: str) -> bool:
    parts = key.split("-")
    return len(parts) == 2 and all(p.strip().isdigit() for p in parts)


def _in_period(year: Column, period: str) -> Column:
    first, last = (int(p) for p in period.split("-"))
    return year.between(first, last)
