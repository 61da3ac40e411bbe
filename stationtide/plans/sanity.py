"""End-to-end checks of stored datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.config import DatasetConfig
from stationtide.functions.tiles import asset_name
from stationtide.functions.times import ts
from stationtide.model.literals import name_table
from stationtide.operators.catalogue import consistency
from stationtide.operators.quality import CheckFailed, retrieved_report
from stationtide.plans.retrieve import NoDataFound, Request, retrieve_stored
from stationtide.sources.store import read_catalogue, stored_sizes

# Box of the routine check.
CHECK_LATITUDES = (-10.0, 80.0)
CHECK_LONGITUDES = (-170.0, 180.0)


def summary_check(catalogue: DataFrame, declared) -> DataFrame:
    """(check, passed, n): some tiles, some stations, and exactly the declared variables."""
    found = catalogue.select(F.explode("variables").alias("name")).distinct()
    wanted = name_table(catalogue.sparkSession, "name", sorted(set(declared))).withColumn("w", F.lit(1))
    difference = found.withColumn("f", F.lit(1)).join(wanted, "name", "full_outer").agg(
        F.lit("variables").alias("check"), F.count_if(F.col("f").isNull() | F.col("w").isNull()).alias("n")
    ).select("check", (F.col("n") == 0).alias("passed"), "n")
    tiles = catalogue.agg(F.lit("tiles").alias("check"), F.count(F.lit(1)).alias("n"))
    stations = catalogue.select(F.explode("stations").alias("s")).distinct().agg(
        F.lit("stations").alias("check"), F.count(F.lit(1)).alias("n")
    )
    counts = tiles.unionByName(stations).select("check", (F.col("n") >= 1).alias("passed"), "n")
    return counts.unionByName(difference)


def require_summary(catalogue: DataFrame, declared) -> None:
    failed = summary_check(catalogue, declared).where(~F.col("passed")).first()
    if failed is not None:
        raise CheckFailed(f"summary check {failed.check} failed with {failed.n}")


def routine_request(source: str, year: int, variables) -> Request:
    """One month in the check box."""
    return Request(
        dataset_source=source, latitude_coverage=CHECK_LATITUDES, longitude_coverage=CHECK_LONGITUDES,
        year=(year,), month=(1,), variables=tuple(variables),
    )


def sanity_report(catalogue: DataFrame, stored_assets: DataFrame, rows: DataFrame, year: int, variables) -> DataFrame:
    """(check, n_rows): storage consistency and the checks on one retrieved month."""
    missing = consistency(catalogue, stored_assets).agg(
        F.lit("missing_in_storage").alias("check"), F.count_if(F.col("problem") == "missing_in_storage").alias("n_rows")
    )
    retrieved = rows.agg(F.lit("retrieved").alias("check"), F.count(F.lit(1)).alias("n_rows"))
    checked = retrieved_report(
        rows, ts(f"{year}-01-01"), ts(f"{year}-02-01"), CHECK_LATITUDES, (CHECK_LONGITUDES[0], 180.1), variables
    )
    return missing.unionByName(retrieved).unionByName(checked)


def sanity_run(spark: SparkSession, root: str, config: DatasetConfig, versions: DataFrame, year: int) -> DataFrame:
    """(source, check, n_rows) over the real store, a pass for each configured source: entries against the files that are
    there, and the checks on one month that is retrieved through the catalogue."""
    catalogue = read_catalogue(spark, root).where(F.col("dataset") == config.name)
    sizes = stored_sizes(spark, root)
    stored = sizes.select("dataset_source", asset_name(
        F.col("dataset"), F.col("version"), F.col("dataset_source"), F.col("time_start"), config.time_tile_size, F.col("lat_start"), F.col("lon_start")).alias("asset"))
    reports = []
    for source, definition in config.sources.items():
        entries = catalogue.where(F.col("dataset_source") == source)
        try:
            rows = retrieve_stored(spark, root, versions, config.name, routine_request(source, year, definition.main_variables), config.time_tile_size)
            report = sanity_report(entries, stored.where(F.col("dataset_source") == source), rows, year, definition.main_variables)
        except NoDataFound:
            report = entries.agg(F.lit("no_data").alias("check"), F.lit(1).cast("bigint").alias("n_rows"))
        reports.append(report.select(F.lit(source).alias("source"), "check", "n_rows"))
    return reduce(DataFrame.unionByName, reports)


def declared_variables(config: DatasetConfig) -> list[str]:
    return sorted({v for c in config.sources.values() for v in c.main_variables})
