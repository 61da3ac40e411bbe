"""The tile catalogue: building, filtering and maintaining it.

A catalogue is one row per tile. Station and variable lists are collected only
after the rows were reduced to distinct (tile, station, variable), so a tile
holding most of the data costs one task its distinct stations, not its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.functions.intervals import LATITUDE_LIMIT, LONGITUDE_LIMIT, holds_point, overlaps, tile_may_hold
from stationtide.functions.names import asset_bucket, asset_file, version_key
from stationtide.functions.tiles import asset_name
from stationtide.operators.tiling import TILE_KEYS, with_bounds

IDENTITY = ["dataset", "version", "dataset_source"]
ENTRY_KEY = IDENTITY + ["time_coverage_start", "time_coverage_end", "latitude_coverage_start",
                        "latitude_coverage_end", "longitude_coverage_start", "longitude_coverage_end"]
PAGE_SIZE = 50
# Bytes of the narrow types; all others take 8.
# Columns whose null marks are put together at once.
MARKED_TOGETHER = 6
FIXED_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4}


def row_hash(columns) -> Column:
    """64-bit hash of a row; columns go in name order so that column order does not matter.

    The hash function skips nulls, so a text with a mark for each column tells where they are.
    """
    return hash_of({c: F.col(f"`{c}`") for c in columns})


def hash_of(cells: dict[str, Column]) -> Column:
    """:func:`row_hash` of a row that is given by its cells."""
    cells = [cells[c] for c in sorted(cells)]
    mark = lambda c: F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1"))
    # Most cells have a value: the marks of a few columns are one constant then, and no text has to be put together.
    few = [cells[i:i + MARKED_TOGETHER] for i in range(0, len(cells), MARKED_TOGETHER)]
    marks = [F.when(reduce(lambda a, b: a & b, (c.isNotNull() for c in some)), F.lit("1" * len(some))).otherwise(F.concat(*map(mark, some))) for some in few]
    return F.xxhash64(F.concat(*marks), *cells)


def row_bytes(df: DataFrame, columns) -> Column:
    """In-memory size of a row: type widths, and the real length of text and binary values."""
    return bytes_of({c: F.col(f"`{c}`") for c in columns}, df)


def bytes_of(cells: dict[str, Column], like: DataFrame) -> Column:
    """:func:`row_bytes` of a row that is given by its cells, with the types of ``like``."""
    fixed, variable = 0, []
    for name, cell in cells.items():
        kind = like.schema[name].dataType
        if kind.typeName() in ("string", "binary"):
            variable.append(F.coalesce(F.octet_length(cell), F.lit(0)))
        else:
            fixed += FIXED_BYTES.get(kind.typeName(), 8)
    return reduce(lambda a, b: a + b, variable, F.lit(fixed)).cast("bigint")


def content_columns(tiled: DataFrame) -> list[str]:
    """Columns of a tiled table that are no keys of its tiles."""
    return [c for c in tiled.columns if c not in TILE_KEYS + ["lat_size", "lon_size"] + IDENTITY]


def tile_parts(tiled: DataFrame, hashed: list[str] | None = None, by_day: bool = False) -> DataFrame:
    """One row per (tile, station, variable): everything a catalogue row is made of.

    Counts, hashes and extremes combine on the map side and merge further, so
    parts of several ingests can be added up. ``by_day`` adds the day to the
    grain: the parts then are the availability of the tile as well, and one pass
    over the rows serves both. The content is the sum of the row hashes, their
    lower and upper 32 bits apart, so that neither order nor repeats get lost.
    """
    content = hashed or content_columns(tiled)
    identity = [c for c in IDENTITY if c in tiled.columns]
    with_hash = tiled.withColumn("_hash", row_hash(content))
    return with_hash.withColumn("_size", row_bytes(tiled, content)).groupBy(
        *identity, *TILE_KEYS, "lat_size", "lon_size", F.col("primary_station_id").cast("string").alias("station"),
        F.col("observed_variable").cast("string").alias("variable"),
        *([F.col("report_timestamp").cast("date").alias("day")] if by_day else []),
    ).agg(
        F.count(F.lit(1)).alias("n_obs"), F.sum("_size").alias("data_size"),
        F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("hash_low"), F.sum(F.shiftrightunsigned("_hash", 32)).alias("hash_high"),
        F.min("report_timestamp").alias("first_time"), F.max("report_timestamp").alias("last_time"),
    )


def tile_parts_of_wide(tiled: DataFrame, cells: dict[str, dict[str, Column]], like: DataFrame, identity: dict[str, str], by_day: bool = False) -> DataFrame:
    """:func:`tile_parts` of rows that are not melted yet: one aggregate row for all variables, and a part for each of them after that.

    ``cells`` are the content columns of the row that each variable will have, with the types of ``like``; ``tiled`` has the tile keys.
    """
    sized, sums = {}, []
    for i, own in enumerate(cells.values()):
        sized |= {f"_hash{i}": hash_of(own), f"_size{i}": bytes_of(own, like)}
        sums += [F.sum(f"_size{i}").alias(f"_size{i}"), F.sum(F.col(f"_hash{i}").bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"_low{i}"),
                 F.sum(F.shiftrightunsigned(f"_hash{i}", 32)).alias(f"_high{i}")]
    day = [F.col("report_timestamp").cast("date").alias("day")] if by_day else []
    grouped = tiled.withColumns(sized).groupBy(*TILE_KEYS, "lat_size", "lon_size", F.col("primary_station_id").cast("string").alias("station"), *day).agg(
        F.count(F.lit(1)).alias("n_obs"), *sums, F.min("report_timestamp").alias("first_time"), F.max("report_timestamp").alias("last_time"))
    each = F.array(*[F.struct(F.lit(v).alias("variable"), *[F.col(f"_{c}{i}").alias(name) for c, name in (("size", "data_size"), ("low", "hash_low"), ("high", "hash_high"))])
                     for i, v in enumerate(cells)])
    return grouped.select("*", F.inline(each)).select(
        *[F.lit(v).alias(c) for c, v in identity.items()], *TILE_KEYS, "lat_size", "lon_size", "station", "variable", *(["day"] if by_day else []),
        "n_obs", "data_size", "hash_low", "hash_high", "first_time", "last_time")


def build_catalogue(parts: DataFrame, time_size: str, dataset: str | None = None, version: str | None = None,
                    declared_variables=None) -> DataFrame:
    """Catalogue rows from tile parts."""
    if dataset is not None:
        parts = parts.withColumn("dataset", F.lit(dataset))
    if version is not None:
        parts = parts.withColumn("version", F.lit(version))
    variables = (
        F.array(*[F.lit(v) for v in sorted(declared_variables)]) if declared_variables else F.array_sort(F.collect_set("variable"))
    )
    grouped = parts.groupBy(*IDENTITY, *TILE_KEYS, "lat_size", "lon_size").agg(
        variables.alias("variables"), F.array_sort(F.collect_set("station")).alias("stations"),
        F.sum("n_obs").alias("n_obs"), F.sum("data_size").alias("data_size"),
        F.sum("hash_low").alias("hash_low"), F.sum("hash_high").alias("hash_high"),
    )
    bounded = with_bounds(grouped, time_size)
    return bounded.select(
        *IDENTITY,
        F.col("time_start").cast("timestamp_ntz").alias("time_coverage_start"),
        F.col("time_end").cast("timestamp_ntz").alias("time_coverage_end"),
        F.col("lat_start").cast("double").alias("latitude_coverage_start"),
        F.col("lat_end").cast("double").alias("latitude_coverage_end"),
        F.col("lon_start").cast("double").alias("longitude_coverage_start"),
        F.col("lon_end").cast("double").alias("longitude_coverage_end"),
        "variables", "stations", F.array().cast("array<string>").alias("sources"),
        asset_name(F.col("dataset"), F.col("version"), F.col("dataset_source"), F.col("time_start"), time_size,
                   F.col("lat_start"), F.col("lon_start")).alias("asset"),
        "n_obs", "data_size", checksum().alias("file_checksum"), "hash_low", "hash_high",
    )


def checksum() -> Column:
    """Text that two tiles share if they hold the same rows, whatever their order and however many runs wrote them."""
    return F.concat_ws("-", F.hex("hash_low"), F.hex("hash_high"), F.col("n_obs").cast("string"))


def merged_entries(held: DataFrame, added: DataFrame) -> DataFrame:
    """``added`` with what ``held`` has of the same assets: an entry is a sum, and so is the entry of several runs.

    Both have at most one row for an asset, so a row grows with the stations of its tile and not with the number of runs.
    """
    sums, sets = ("n_obs", "data_size", "file_size", "hash_low", "hash_high"), ("variables", "stations", "sources")
    before = held.select("asset", *[F.col(c).alias(f"_{c}") for c in (*sums, *sets, "runs")])
    both = added.join(before, "asset", "left")
    nothing = F.array().cast("array<string>")
    united = lambda c: F.array_union(F.coalesce(f"_{c}", nothing), F.col(c))
    summed = both.withColumns({**{c: F.coalesce(f"_{c}", F.lit(0)) + F.col(c) for c in sums},
                               **{c: F.array_sort(united(c)) for c in sets}, "runs": united("runs")})
    return summed.withColumn("file_checksum", checksum()).select(*added.columns)


def catalogue_of(tiled: DataFrame, time_size: str, dataset: str, version: str, declared_variables=None) -> DataFrame:
    return build_catalogue(tile_parts(tiled), time_size, dataset, version, declared_variables)


def _one_of(column: str):
    return lambda names: F.col(column).isin([names] if isinstance(names, str) else list(names))


def _span(axis: str, kind: str):
    """One value is a point that the entry's closed range holds, two are a half-open range that it meets."""
    def test(values) -> Column:
        start, end = F.col(f"{axis}_coverage_start"), F.col(f"{axis}_coverage_end")
        ends = [F.lit(v).cast(kind) for v in values]
        if len(ends) > 2:
            raise ValueError(f"{axis} takes one value or two")
        return holds_point(start, end, *ends) if len(ends) == 1 else overlaps(start, end, *ends)

    return test


def _box(axis: str, limit: float):
    return lambda ends: tile_may_hold(F.col(f"{axis}_coverage_start"), F.col(f"{axis}_coverage_end"), *ends, limit)


#: What can be asked of an entry, by name: the wanted value to a predicate.
ENTRY_TESTS = {
    "dataset": _one_of("dataset"),
    "dataset_source": _one_of("dataset_source"),
    "version": _one_of("version"),
    "stations": lambda names: shares_element("stations", names),
    "variables": lambda names: shares_element("variables", names),
    "time": _span("time", "timestamp_ntz"),
    "latitudes": _span("latitude", "double"),
    "longitudes": _span("longitude", "double"),
    # Of a retrieval: no entry that may hold a row is lost, those on the ends of the axes included.
    "latitude_box": _box("latitude", LATITUDE_LIMIT),
    "longitude_box": _box("longitude", LONGITUDE_LIMIT),
    "months": lambda asked: holds_any_month(*asked),
}


def entries_with(**wanted) -> Column:
    """Predicate on entries: every test of ENTRY_TESTS whose value is given and not blank."""
    return reduce(lambda a, b: a & b, (ENTRY_TESTS[name](value) for name, value in wanted.items() if value), F.lit(True))


@dataclass(frozen=True)
class CatalogueFilter:
    """Optional catalogue conditions; blank ones are left out."""

    dataset: str = ""
    dataset_source: str = ""
    time: tuple = ()
    latitudes: tuple = ()
    longitudes: tuple = ()
    variables: tuple[str, ...] = ()
    stations: tuple[str, ...] = ()
    versions: tuple[str, ...] = ()
    deprecated: bool | str = False

    def condition(self) -> Column:
        asked = {name: value for name, value in vars(self).items() if name in ENTRY_TESTS}
        return entries_with(**asked, version=self.versions)


def shares_element(column: str, values) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values]))


def filter_catalogue(catalogue: DataFrame, versions: DataFrame | None, wanted: CatalogueFilter) -> DataFrame:
    out = catalogue.where(wanted.condition())
    if wanted.deprecated != "all":
        out = with_deprecation(out, versions, bool(wanted.deprecated))
    return out


def with_deprecation(catalogue: DataFrame, versions: DataFrame, deprecated: bool) -> DataFrame:
    """Entries whose dataset version has this deprecation flag."""
    keys = versions.where(F.col("deprecated") == deprecated).select("dataset", "version")
    return catalogue.join(keys, ["dataset", "version"], "left_semi")


def of_months(catalogue: DataFrame, years, months=None) -> DataFrame:
    """Tiles whose time range holds the first day of any requested month."""
    return catalogue.where(holds_any_month(years, months))


def holds_any_month(years, months=None) -> Column:
    firsts = F.array(*[
        F.to_timestamp_ntz(F.lit(f"{y:04d}-{m:02d}-01 00:00:00")) for y in years for m in (months or range(1, 13))
    ])
    start, end = F.col("time_coverage_start"), F.col("time_coverage_end")
    return F.exists(firsts, lambda d: (start <= d) & (d < end))


def in_catalogue_order(catalogue: DataFrame) -> DataFrame:
    """Time start, latitude start, longitude end; ties by asset so that pages are stable."""
    return catalogue.orderBy("time_coverage_start", "latitude_coverage_start", "longitude_coverage_end", "asset")


def page_of(ordered: DataFrame, page: int, first_page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    return ordered.offset((page - first_page) * size).limit(size)


def last_versions(versions: DataFrame) -> DataFrame:
    """Greatest non-deprecated version of each dataset, by version order and not by text."""
    return versions.where(~F.col("deprecated")).groupBy("dataset").agg(
        F.max_by("version", version_key(F.col("version"))).alias("version")
    )


def missing_entries(new: DataFrame, existing: DataFrame, cell: int = 5) -> DataFrame:
    """New tiles without an entry of the same dataset, source, version and time inside the same box.

    Containment is looked up through a lattice: an entry belongs to the cell of
    its lower corner, a new tile to every cell it touches. Tiles of one month
    are thus compared within a cell and not all with all.
    """
    same = IDENTITY + ["time_coverage_start", "time_coverage_end"]
    touched = lambda a, b: F.explode(F.sequence(_cell(a, cell), _cell(b, cell)))
    spread = (
        new.select(*ENTRY_KEY)
        .withColumn("_lat", touched("latitude_coverage_start", "latitude_coverage_end"))
        .withColumn("_lon", touched("longitude_coverage_start", "longitude_coverage_end"))
    )
    stored = existing.select(
        *same, _cell("latitude_coverage_start", cell).alias("_lat"), _cell("longitude_coverage_start", cell).alias("_lon"),
        *[F.col(c).alias(f"_e_{c}") for c in ENTRY_KEY[5:]],
    )
    inside = (
        (F.col("_e_longitude_coverage_start") >= F.col("longitude_coverage_start"))
        & (F.col("_e_longitude_coverage_end") <= F.col("longitude_coverage_end"))
        & (F.col("_e_latitude_coverage_start") >= F.col("latitude_coverage_start"))
        & (F.col("_e_latitude_coverage_end") <= F.col("latitude_coverage_end"))
    )
    found = spread.join(stored, [*same, "_lat", "_lon"]).where(inside).select(*ENTRY_KEY).distinct()
    return new.join(found, ENTRY_KEY, "left_anti")


def _cell(column: str, size: int) -> Column:
    return F.floor(F.col(column) / size).cast("int")


def tile_status(new: DataFrame, existing: DataFrame) -> DataFrame:
    """``new``, ``exists_identical`` or ``exists_different`` per asset."""
    stored = existing.select("asset", F.col("file_checksum").alias("_stored"))
    status = F.when(F.col("_stored").isNull(), "new").when(
        F.col("_stored") == F.col("file_checksum"), "exists_identical"
    ).otherwise("exists_different")
    return new.join(stored, "asset", "left").withColumn("status", status).drop("_stored")


def assets_present(assets: DataFrame, catalogue: DataFrame) -> DataFrame:
    return assets.join(catalogue.select("asset"), "asset", "left_semi")


def copy_entries(catalogue: DataFrame, versions: DataFrame, dataset: str, version: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(entries to add under ``target``, versions to add). Entries that already exist are skipped."""
    if target == dataset or not target or target.replace(" ", "_").lower() != target:
        raise ValueError(f"{target!r} is no other dataset name in lower case with underscores")
    source = catalogue.where((F.col("dataset") == dataset) & (F.col("version") == version))
    renamed = source.withColumns({
        "dataset": F.lit(target), "asset": F.concat(F.lit(target + "/"), asset_file(F.col("asset")))
    })
    added = missing_entries(renamed, catalogue.where(F.col("dataset") == target))
    return added, absent_versions(versions, added.select("dataset", "version").distinct())


def absent_versions(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Version rows to create; a new version starts deprecated."""
    return wanted.join(versions.select("dataset", "version"), ["dataset", "version"], "left_anti").withColumn(
        "deprecated", F.lit(True)
    )


def absent_datasets(datasets: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("dataset").distinct().join(datasets, "dataset", "left_anti")


def delete_entries(catalogue: DataFrame, wanted: CatalogueFilter) -> tuple[DataFrame, DataFrame]:
    """(remaining entries, deleted entries). Nothing is written, so this is also the dry run."""
    condition = F.coalesce(wanted.condition(), F.lit(False))
    return catalogue.where(~condition), catalogue.where(condition)


def without_empty_versions(versions: DataFrame, remaining: DataFrame) -> DataFrame:
    """Versions that still have entries."""
    return versions.join(remaining.select("dataset", "version"), ["dataset", "version"], "left_semi")


def empty_versions(versions: DataFrame, remaining: DataFrame) -> DataFrame:
    return versions.join(remaining.select("dataset", "version"), ["dataset", "version"], "left_anti")


def set_deprecated(versions: DataFrame, dataset: str, version: str, deprecated: bool) -> DataFrame:
    """Flip one version; an unknown version is an error."""
    key = (F.col("dataset") == dataset) & (F.col("version") == version)
    if versions.where(key).isEmpty():
        raise LookupError(f"{dataset} {version} is not in the catalogue")
    return versions.withColumn("deprecated", F.when(key, F.lit(deprecated)).otherwise(F.col("deprecated")))


def migrate_to_versions(catalogue: DataFrame, version: str = "1.0.0") -> DataFrame:
    """Give unversioned entries a version and put it into their asset names."""
    file_name = F.replace(asset_file(F.col("asset")), F.col("dataset"), F.concat(F.col("dataset"), F.lit("_" + version)))
    return catalogue.withColumns({
        "version": F.lit(version), "asset": F.concat(asset_bucket(F.col("asset")), F.lit("/"), file_name)
    })


def consistency(catalogue: DataFrame, stored: DataFrame) -> DataFrame:
    """Assets on one side only: ``missing_in_storage`` or ``missing_in_catalogue``."""
    a = catalogue.select("asset").distinct().withColumn("_c", F.lit(1))
    b = stored.select("asset").distinct().withColumn("_s", F.lit(1))
    problem = F.when(F.col("_s").isNull(), "missing_in_storage").when(F.col("_c").isNull(), "missing_in_catalogue")
    return a.join(b, "asset", "full_outer").select("asset", problem.alias("problem")).where(F.col("problem").isNotNull())


def insert_entries(catalogue: DataFrame, rows: DataFrame) -> DataFrame:
    return catalogue.unionByName(rows)


def remove_assets(catalogue: DataFrame, assets: DataFrame) -> DataFrame:
    return catalogue.join(assets.select("asset"), "asset", "left_anti")


def asset_urls(catalogue: DataFrame, storage_url: str) -> DataFrame:
    return catalogue.withColumn("url", F.concat(F.lit(storage_url.rstrip("/") + "/"), F.col("asset")))


def capabilities(catalogue: DataFrame) -> DataFrame:
    """Dataset and source listing."""
    return catalogue.select("dataset", "dataset_source").distinct()
