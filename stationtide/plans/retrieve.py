"""Retrieval: request -> catalogue predicate -> tile predicate -> row filter -> columns."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationtide.functions.intervals import LATITUDE_LIMIT, LONGITUDE_LIMIT, coordinate_within, within
from stationtide.functions.names import VERSION_PATTERN
from stationtide.functions.times import ts
from stationtide.model.lite import lite_columns
from stationtide.session import broadcast_if_small
from stationtide.sources.store import files_of, read_catalogue, read_files
from stationtide.operators.catalogue import entries_with, in_catalogue_order, last_versions

FORMATS = {"netCDF": "parquet", "parquet": "parquet", "csv": "csv"}


class NoDataFound(LookupError):
    """No catalogue entry matches the request."""


@dataclass(frozen=True)
class Request:
    """What to retrieve; blank fields do not restrict."""

    dataset_source: str | None = None
    stations: tuple[str, ...] | None = None
    variables: tuple[str, ...] | None = None
    latitude_coverage: tuple[float, float] | None = None
    longitude_coverage: tuple[float, float] | None = None
    time_coverage: tuple[str, str] | None = None
    year: tuple[int, ...] | None = None
    month: tuple[int, ...] | None = None
    day: tuple[int, ...] | None = None
    format: str = "parquet"
    version: str = "last"

    def __post_init__(self) -> None:
        for name in ("latitude_coverage", "longitude_coverage", "time_coverage"):
            value = getattr(self, name)
            if value is not None and not value[0] < value[1]:
                raise ValueError(f"{name} must be increasing")
        if self.time_coverage is not None and self.year is not None:
            raise ValueError("use either time_coverage or year")
        if self.version != "last" and not re.match(VERSION_PATTERN, self.version):
            raise ValueError(f"{self.version!r} is neither 'last' nor a version")
        if self.format not in FORMATS:
            raise ValueError(f"format must be one of {sorted(FORMATS)}")

    def row_condition(self) -> Column:
        """Exact filter on observation rows."""
        terms = []
        if self.stations:
            terms.append(F.col("primary_station_id").isin(list(self.stations)))
        if self.variables:
            terms.append(F.col("observed_variable").isin(list(self.variables)))
        if self.latitude_coverage:
            terms.append(coordinate_within(F.col("latitude"), *self.latitude_coverage, LATITUDE_LIMIT))
        if self.longitude_coverage:
            terms.append(coordinate_within(F.col("longitude"), *self.longitude_coverage, LONGITUDE_LIMIT))
        time = F.col("report_timestamp")
        if self.time_coverage:
            terms.append(within(time, ts(self.time_coverage[0]), ts(self.time_coverage[1])))
        if self.year:
            # The range lets Parquet skip row groups, which the year function alone cannot.
            terms.append(within(time, ts(f"{min(self.year)}-01-01"), ts(f"{max(self.year) + 1}-01-01")))
            terms.append(F.year(time).isin(list(self.year)))
            if self.month:
                terms.append(F.month(time).isin(list(self.month)))
            if self.day:
                terms.append(F.dayofmonth(time).isin(list(self.day)))
        return _all(terms)

    def entry_condition(self, dataset: str | None = None) -> Column:
        """Filter on catalogue entries; keeps every entry that may hold a requested row.

        A yearly tile holds the first of every month of its year, a monthly one of its own.
        """
        return entries_with(
            dataset=dataset, dataset_source=self.dataset_source, version=None if self.version == "last" else self.version,
            stations=self.stations, variables=self.variables, time=self.time_coverage, latitude_box=self.latitude_coverage,
            longitude_box=self.longitude_coverage, months=self.year and (self.year, self.month))

    def file_condition(self) -> Column:
        """Filter on files by the times of their rows."""
        first, last = F.col("first_time"), F.col("last_time")
        terms = []
        if self.time_coverage:
            terms.append((last >= ts(self.time_coverage[0])) & (first < ts(self.time_coverage[1])))
        if self.year:
            terms.append((last >= ts(f"{min(self.year)}-01-01")) & (first < ts(f"{max(self.year) + 1}-01-01")))
        return _all(terms)

    def tile_condition(self, time_size: str, lat_size: int | None = None, lon_size: int | None = None) -> Column:
        """Static predicate on the tile keys: prunes partition directories without a join."""
        terms = []
        for key, axis, size, limit in (("lat_start", self.latitude_coverage, lat_size, LATITUDE_LIMIT), ("lon_start", self.longitude_coverage, lon_size, LONGITUDE_LIMIT)):
            if axis:
                if axis[1] < limit:
                    terms.append(F.col(key) < axis[1])
                if size:
                    terms.append(F.col(key) > axis[0] - size)
        start = F.col("time_start")
        lead = F.add_months
        if self.time_coverage:
            first, last = ts(self.time_coverage[0]), ts(self.time_coverage[1])
            months = -1 if time_size == "month" else -12
            terms.append((start.cast("timestamp_ntz") < last) & (start > lead(first.cast("date"), months)))
        if self.year:
            terms.append(F.year(start).isin(list(self.year)))
            if self.month and time_size == "month":
                terms.append(F.month(start).isin(list(self.month)))
        return _all(terms)


def _all(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def resolve_version(versions: DataFrame, dataset: str) -> str:
    """Greatest non-deprecated version; none is an error."""
    row = last_versions(versions.where(F.col("dataset") == dataset)).first()
    if row is None:
        raise NoDataFound(f"{dataset} has no active version")
    return row.version


def request_entries(catalogue: DataFrame, versions: DataFrame, dataset: str, request: Request) -> DataFrame:
    """Catalogue entries of a request, in catalogue order. ``last`` is resolved inside the plan."""
    found = catalogue.where(request.entry_condition(dataset))
    if request.version == "last":
        found = found.join(last_versions(versions), ["dataset", "version"], "left_semi")
    return in_catalogue_order(found)


def require_entries(entries: DataFrame) -> DataFrame:
    if entries.isEmpty():
        raise NoDataFound("no catalogue entry matches this request")
    return entries


def retrieve_rows(observations: DataFrame, request: Request, disabled=()) -> DataFrame:
    """Row filter and column choice over an observation table."""
    rows = observations.where(request.row_condition())
    if request.dataset_source and "dataset_source" in observations.columns:
        rows = rows.where(F.col("dataset_source") == request.dataset_source)
    offered = lite_columns(disabled)
    return rows.select(*[F.col(f"`{c}`") for c in observations.columns if c in offered])


def retrieve_from_store(tiles: DataFrame, catalogue: DataFrame, versions: DataFrame, dataset: str, request: Request,
                        time_size: str, disabled=()) -> DataFrame:
    """Retrieve through the catalogue; tiles that are not listed there are not read.

    The static tile predicate prunes directories at planning time. The filtered
    catalogue is semi-joined on the tile keys, which are partition columns, so
    that the join prunes further directories at run time. It is broadcast only
    after its rows were counted.
    """
    version = request.version if request.version != "last" else resolve_version(versions, dataset)
    entries = catalogue.where(request.entry_condition(dataset) & (F.col("version") == version))
    keys = entries.select(
        "dataset", "version", "dataset_source", F.col("time_coverage_start").cast("date").alias("time_start"),
        F.col("latitude_coverage_start").cast("int").alias("lat_start"),
        F.col("longitude_coverage_start").cast("int").alias("lon_start"),
        *([F.explode("runs").alias("run")] if "runs" in entries.columns and "run" in tiles.columns else []),
    )
    pruned = tiles.where((F.col("dataset") == dataset) & (F.col("version") == version) & request.tile_condition(time_size))
    if request.dataset_source:
        pruned = pruned.where(F.col("dataset_source") == request.dataset_source)
    rows = pruned.where(request.row_condition()).join(broadcast_if_small(keys), keys.columns, "left_semi")
    offered = lite_columns(disabled)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c in offered])


def retrieve_stored(spark: SparkSession, root: str, versions: DataFrame, dataset: str, request: Request, time_size: str,
                    disabled=()) -> DataFrame:
    """Retrieve from a store by its own catalogue: entries first, then only the files that hold their tiles.

    The files come from the manifests of the runs that the entries name, less those whose times lie outside the request; no
    directory is searched, and no other file is opened. No matching entry raises :class:`NoDataFound`.
    """
    catalogue = read_catalogue(spark, root)
    version = request.version if request.version != "last" else resolve_version(versions, dataset)
    entries = require_entries(catalogue.where(request.entry_condition(dataset) & (F.col("version") == version)))
    tiles = read_files(spark, root, files_of(spark, root, entries).where(request.file_condition()))
    rows = tiles.where(request.tile_condition(time_size) & request.row_condition())
    offered = lite_columns(disabled)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c in offered])


def write_result(rows: DataFrame, request: Request, path: str) -> None:
    writer = rows.write.mode("overwrite")
    if FORMATS[request.format] == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
