"""Time x latitude x longitude tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationtide.config import DatasetConfig, SpaceColumns
from stationtide.functions.tiles import (
    latitude_tile, latitude_tile_end, longitude_tile, longitude_tile_end, per_year_size,
)
from stationtide.functions.times import period_end, period_start

TILE_KEYS = ["time_start", "lat_start", "lon_start"]


def with_coordinates(df: DataFrame, space: SpaceColumns) -> tuple[DataFrame, DataFrame]:
    """(rows that belong to a tile, rows without a coordinate)."""
    has_both = F.col(space.x).isNotNull() & F.col(space.y).isNotNull()
    return df.where(has_both), df.where(~has_both)


def assign_tiles(
    df: DataFrame, lat_size=5, lon_size=5, time_size: str = "month", space: SpaceColumns = SpaceColumns("longitude", "latitude"),
    time_column: str = "report_timestamp", source_column: str = "dataset_source",
) -> DataFrame:
    """Add the tile keys and sizes. Rows without a coordinate or without a time belong to no tile and are dropped.

    Sizes may depend on source and year; data of several years then gets its
    sizes row by row, without a join.
    """
    kept = with_coordinates(df, space)[0].where(F.col(time_column).isNotNull())
    year = F.year(time_column)
    source = F.col(source_column) if source_column in df.columns else F.lit("")
    lat, lon = per_year_size(lat_size, source, year), per_year_size(lon_size, source, year)
    return kept.withColumns({
        "time_start": period_start(F.col(time_column), time_size),
        "lat_start": latitude_tile(F.col(space.y), lat),
        "lon_start": longitude_tile(F.col(space.x), lon),
        "lat_size": lat, "lon_size": lon,
    })


def assign_dataset_tiles(df: DataFrame, config: DatasetConfig, source: str) -> DataFrame:
    return assign_tiles(
        df, config.lat_tile_size, config.lon_tile_size, config.time_tile_size, config.space_of(source)
    )


def with_bounds(tiles: DataFrame, time_size: str = "month") -> DataFrame:
    """Upper tile bounds, clipped at the ends of the axes."""
    return tiles.withColumns({
        "time_end": period_end(F.col("time_start"), time_size),
        "lat_end": latitude_tile_end(F.col("lat_start"), F.col("lat_size")),
        "lon_end": longitude_tile_end(F.col("lon_start"), F.col("lon_size")),
    })


def cluster_by_tile(df: DataFrame, keys: list[str], space: SpaceColumns = SpaceColumns("longitude", "latitude")) -> DataFrame:
    """Bring the rows of a tile together and sort them for storage.

    ``rebalance`` lets adaptive execution split a tile that is far larger than
    the others and merge small ones, so no task has to hold a whole tile.
    """
    return sort_by_tile(df.hint("rebalance", *[F.col(k) for k in keys]), keys, space)


def gather_by_tile(df: DataFrame, config: DatasetConfig, source: str) -> DataFrame:
    """Bring the rows of a tile together before they are melted, so that a row is shuffled once and not once for each variable.

    Rows that belong to no tile are left out, as in :func:`assign_tiles`.
    """
    tiled = assign_dataset_tiles(df.withColumn("dataset_source", F.lit(source)), config, source)
    return tiled.hint("rebalance", *[F.col(k) for k in TILE_KEYS]).drop("dataset_source", *TILE_KEYS, "lat_size", "lon_size")


def sort_by_tile(df: DataFrame, keys: list[str], space: SpaceColumns = SpaceColumns("longitude", "latitude")) -> DataFrame:
    """Storage order within each task, for rows that are together already."""
    order = [F.col(k).asc() for k in keys]
    order += [F.col(c).asc_nulls_last() for c in ("report_timestamp", space.y, space.x)]
    if "observation_id" in df.columns:
        order.append(F.col("observation_id").asc_nulls_last())
    return df.sortWithinPartitions(*order)


def time_batches(data: DataFrame, time_column: str, size: str = "month") -> DataFrame:
    """Batches covering the data, from its first to its last period, with their row counts.

    Batches without rows are kept with a count of zero.
    """
    counted = (
        data.where(F.col(time_column).isNotNull()).groupBy(period_start(F.col(time_column), size).alias("batch_start")).agg(F.count(F.lit(1)).alias("n"))
    )
    step = F.expr("interval 1 month" if size == "month" else "interval 1 year")
    calendar = counted.agg(F.min("batch_start").alias("a"), F.max("batch_start").alias("b")).select(
        F.explode(F.sequence("a", "b", step)).alias("batch_start")
    )
    return calendar.join(counted, "batch_start", "left").select(
        "batch_start", period_end(F.col("batch_start"), size).alias("batch_end"), F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def declared_batches(spark, start_year: int, end_year: int, start_month: int = 1, size: str = "month") -> DataFrame:
    """Batches of a requested ingestion; the start month counts for monthly batches only."""
    if size not in ("month", "year"):
        raise ValueError(f"time tile size must be 'month' or 'year', got {size!r}")
    first = f"{start_year}-{start_month if size == 'month' else 1:02d}-01"
    step = F.expr(f"interval 1 {size}")
    months = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(f"{end_year}-12-01" if size == "month" else f"{end_year}-01-01")), step)
    return spark.range(1).select(F.explode(months).alias("batch_start")).withColumn(
        "batch_end", period_end(F.col("batch_start"), size)
    )


def space_batches(batches: DataFrame, lat_size: int, lon_size: int) -> DataFrame:
    """Every longitude x latitude batch of every time batch."""
    lats = F.sequence(F.lit(-90), F.lit(90 - lat_size), F.lit(lat_size))
    lons = F.sequence(F.lit(-180), F.lit(180 - lon_size), F.lit(lon_size))
    out = batches.withColumn("lon_start", F.explode(lons)).withColumn("lat_start", F.explode(lats))
    return out.withColumns({"lon_end": F.col("lon_start") + lon_size, "lat_end": F.col("lat_start") + lat_size})
