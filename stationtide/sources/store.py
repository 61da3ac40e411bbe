"""The tile store: one directory per tile and run, and a log of commits that says which of them count.

Layout below the root::

    tiles/run=<run>/dataset=/version=/dataset_source=/time_start=/lat_start=/lon_start=/*.parquet
    schemas/run=<run>/*.parquet    the columns of the run's tiles
    parts/run=<run>/*.parquet      availability and catalogue parts of the run's tiles
    files/run=<run>/*.parquet      manifest: the run's files with their tile, size, rows and times
    catalogue/<commit>/*.parquet   the entries that a commit wrote, one row per tile, naming the runs that hold it
    batches/<commit>/*.parquet     what a commit has taken in, so that the same input is known again
    log/<number>                   the commits in their order, one small file for each
    versions/*.parquet             registered versions of the datasets

An entry is the newest row of its tile. A run that dies leaves files that no entry names, so nobody reads them; its
repetition is a new run. Nothing is overwritten while others may read it.

A commit counts from the moment its file in the log is created, which fails if the number is taken. Then the writer
looks at what came in between: if that touched a tile of its own, its work rests on old entries and the commit is
refused (:class:`CommitConflict`), otherwise it takes the next number.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stationtide.config import ConfigError, SpaceColumns
from stationtide.operators.catalogue import IDENTITY, absent_versions, merged_entries
from stationtide.operators.tiling import TILE_KEYS, cluster_by_tile, sort_by_tile
from stationtide.session import cut_lineage, smaller_partitions

LAYOUT = IDENTITY + TILE_KEYS
VERSIONS = "dataset string, version string, deprecated boolean"
ENTRIES = (
    "dataset string, version string, dataset_source string, time_coverage_start timestamp_ntz, time_coverage_end timestamp_ntz, "
    "latitude_coverage_start double, latitude_coverage_end double, longitude_coverage_start double, longitude_coverage_end double, "
    "variables array<string>, stations array<string>, sources array<string>, asset string, n_obs bigint, data_size bigint, "
    "file_checksum string, hash_low bigint, hash_high bigint, file_size bigint, runs array<string>, run string"
)
_LOGGED = ENTRIES + ", commit string"
BATCHES = "dataset string, version string, dataset_source string, mark string, batch_start date, n_raw bigint, raw_low bigint, raw_high bigint"
FILES = ("path string, bytes bigint, n_rows bigint, first_time timestamp_ntz, last_time timestamp_ntz, dataset string, version string, "
         "dataset_source string, time_start date, lat_start int, lon_start int, run string")
#: Start of the names of runs that a stream wrote.
RUN_MARK = "s-"


class CommitConflict(RuntimeError):
    """Another writer has changed a tile of this commit since its state was read."""


@dataclass(frozen=True)
class Commit:
    """One file of the log: its number, its name, the run it lists, whether it has entries and batches, and whether it replaces all before."""

    number: int
    name: str
    run: str | None = None
    entries: bool = True
    batches: bool = False
    whole: bool = False


def new_run() -> str:
    return "r" + uuid.uuid4().hex


def write_tiles(tiled: DataFrame, root: str, run: str, constants: dict[str, str] | None = None,
                space: SpaceColumns = SpaceColumns("longitude", "latitude"), compression: str = "zstd",
                max_rows_per_file: int = 20_000_000, gathered: int | None = None) -> None:
    """Write the tiles of one run as partition directories, sorted inside each tile.

    ``constants`` are the leading layout columns with one value for all rows.
    They go into the path instead of the partition columns: Spark drops constant
    sort keys, and would then re-sort by the partition columns alone and lose
    the order inside a tile.

    ``gathered`` says that the rows of a tile are together already, and how many of
    them come from one row that was shuffled.
    """
    constants = constants or {}
    if list(constants) != LAYOUT[: len(constants)]:
        raise ValueError(f"constants must be the first of {LAYOUT}, in this order")
    keys = LAYOUT[len(constants):]
    folder = "/".join([f"{root}/tiles/run={run}", *[f"{k}={quote(v, safe='')}" for k, v in constants.items()]])
    ordered = (sort_by_tile if gathered else cluster_by_tile)(tiled.drop(*constants), keys, space)
    with smaller_partitions(tiled.sparkSession, gathered or 1):
        (
            ordered.write.mode("overwrite").option("compression", compression)
            .option("maxRecordsPerFile", max_rows_per_file).partitionBy(*keys).parquet(folder)
        )
    columns = T.StructType([f for f in tiled.schema.fields if f.name not in LAYOUT])
    tiled.sparkSession.range(1).select(F.lit(columns.json()).alias("schema")).coalesce(1).write.mode("overwrite").parquet(f"{root}/schemas/run={run}")


# Types of the partition columns; identity values that look like numbers come back as they were written.
KEY_TYPES = {"time_start": T.DateType(), "lat_start": T.IntegerType(), "lon_start": T.IntegerType()}


def run_schemas(spark: SparkSession, root: str, runs: list[str] | None = None) -> dict[str, list[str]]:
    """Schema of the tiles -> runs that have it. There are as many schemas as sources with unlike columns."""
    if runs is None:
        stored = spark.read.schema("schema string, run string").parquet(f"{root}/schemas")
    else:
        stored = _of_runs(spark, root, "schemas", runs, "schema string, run string")
    found: dict[str, list[str]] = {}
    for row in stored.collect():
        found.setdefault(row.schema, []).append(row.run)
    return {schema: sorted(names) for schema, names in sorted(found.items())}


def read_tiles(spark: SparkSession, root: str, runs: list[str] | None = None) -> DataFrame:
    """Stored tiles with typed keys, of the named runs only or of all; predicates on the keys prune directories.

    Runs with the same columns are one scan of their own folders. Columns that only some runs have are null for the others;
    a column with unlike types is an error. No file is opened to find the columns.
    """
    return _scan(spark, root, {schema: [f"{root}/tiles/run={r}" for r in names] for schema, names in run_schemas(spark, root, runs).items()})


def _scan(spark: SparkSession, root: str, paths: dict[str, list[str]]) -> DataFrame:
    """Paths below the tiles, grouped by the schema of their columns, as one table with typed keys."""
    keys = T.StructType([T.StructField("run", T.StringType())] + [T.StructField(k, KEY_TYPES.get(k, T.StringType())) for k in LAYOUT])
    scans, types = [], {}
    for schema, places in paths.items():
        columns = T.StructType.fromJson(json.loads(schema))
        for f in columns.fields:
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise ConfigError(f"column {f.name} is stored as {types[f.name].simpleString()} and as {f.dataType.simpleString()}")
        scans.append(spark.read.schema(T.StructType(columns.fields + keys.fields)).option("basePath", f"{root}/tiles").parquet(*places))
    if not scans:
        return spark.createDataFrame([], keys)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def listed_keys(catalogue: DataFrame) -> DataFrame:
    """(run, tile) of every run that holds rows of an entry."""
    return catalogue.select(
        F.explode("runs").alias("run"), *IDENTITY, F.col("time_coverage_start").cast("date").alias("time_start"),
        F.col("latitude_coverage_start").cast("int").alias("lat_start"),
        F.col("longitude_coverage_start").cast("int").alias("lon_start"),
    )


def read_listed_tiles(spark: SparkSession, root: str, entries: DataFrame | None = None) -> DataFrame:
    """Tiles of all entries, or of the given ones: a scan of the files in the manifests of their runs, and of no others."""
    return read_files(spark, root, files_of(spark, root, read_catalogue(spark, root) if entries is None else entries))


def files_of(spark: SparkSession, root: str, entries: DataFrame) -> DataFrame:
    """FILES of the entries, from the manifests of the runs they name."""
    listed = cut_lineage(listed_keys(entries))
    runs = sorted(r.run for r in listed.select("run").distinct().collect())
    return _of_runs(spark, root, "files", runs, FILES).join(listed, listed.columns, "left_semi")


def read_files(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The rows of ``files`` (path, run): one scan for each set of columns. The paths pass the driver, as they do in any scan."""
    paths: dict[str, list[str]] = {}
    for row in files.select("run", "path").collect():
        paths.setdefault(row.run, []).append(f"{root}/{row.path}")
    return _scan(spark, root, {schema: sorted(p for r in runs for p in paths[r]) for schema, runs in run_schemas(spark, root, sorted(paths)).items()})


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "time_start": F.col("time_start").cast("date"),
        "lat_start": F.col("lat_start").cast("int"), "lon_start": F.col("lon_start").cast("int"),
    })


def _decoded(text: Column) -> Column:
    """Text of a path without its percent signs; a plus sign stands for itself."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def stored_sizes(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """File bytes per stored tile, from a file listing: no data file is opened.

    The keys are taken from the path, where they are text, so that identity
    values that look like numbers stay as they were written.
    """
    folder = f"{root}/tiles/run={run}" if run is not None else f"{root}/tiles"
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .load(folder).select("path", "length")
    )
    listed = files.select(*[_decoded(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)).alias(c) for c in ("run", *LAYOUT)], "length")
    return _typed(listed).groupBy("run", *LAYOUT).agg(F.sum("length").alias("file_size"), F.count(F.lit(1)).alias("n_files"))


def _of_runs(spark: SparkSession, root: str, folder: str, runs: list[str], schema: str) -> DataFrame:
    """What the named runs wrote below ``folder``; the folders of other runs are not looked at."""
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/{folder}").parquet(*[f"{root}/{folder}/run={r}" for r in runs])


def write_manifest(spark: SparkSession, root: str, run: str) -> DataFrame:
    """List the files of a run with their tile, size, rows and times. Only the times are read, and paths are decoded once a file."""
    tiles = read_tiles(spark, root, [run])
    # Tile keys go with the file, so they are read from its path afterwards and are no keys of the aggregate.
    listed = tiles.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"),
        F.min("report_timestamp").alias("first_time"), F.max("report_timestamp").alias("last_time"))
    # The path comes encoded as a URI; names below the root are kept as they are on disk.
    path = F.regexp_extract(_decoded(F.col("path")), r"(tiles/run=.*)$", 1)
    files = _typed(listed.withColumn("path", path).withColumns({c: _decoded(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)) for c in LAYOUT}))
    folder = f"{root}/files/run={run}"
    files.select("path", "bytes", "n_rows", "first_time", "last_time", *LAYOUT).write.mode("overwrite").parquet(folder)
    return _of_runs(spark, root, "files", [run], FILES)


def write_parts(parts: DataFrame, root: str, run: str) -> DataFrame:
    """Parts of one run; they count once the catalogue names the run."""
    path = f"{root}/parts/run={run}"
    parts.write.mode("overwrite").parquet(path)
    return parts.sparkSession.read.schema(parts.schema).parquet(path)


def read_parts(spark: SparkSession, root: str, entries: DataFrame | None = None) -> DataFrame:
    """Availability parts of the listed tiles, or of the given entries."""
    return parts_of(spark, root, listed_keys(read_catalogue(spark, root) if entries is None else entries))


def parts_of(spark: SparkSession, root: str, pieces: DataFrame) -> DataFrame:
    """Availability parts of ``pieces`` (run and tile keys); the folders of other runs are not looked at."""
    pieces = cut_lineage(pieces)
    runs = sorted(r.run for r in pieces.select("run").distinct().collect())
    if not runs:
        raise LookupError("no tile is listed")
    found = spark.read.option("basePath", f"{root}/parts").parquet(*[f"{root}/parts/run={r}" for r in runs]).withColumn("run", F.col("run").cast("string"))
    return found.join(pieces, pieces.columns, "left_semi").drop("run")


def read_log(spark: SparkSession, root: str) -> list[Commit]:
    """All commits in their order: a line for each ingestion. One that died while it was logged has no line and is nothing."""
    try:
        lines = spark.read.text(f"{root}/log").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Commit(**json.loads(r.value)) for r in lines), key=lambda c: c.number)


def _since_whole(log: list[Commit]) -> list[Commit]:
    start = max((i for i, c in enumerate(log) if c.whole), default=0)
    return log[start:]


def _logged_entries(spark: SparkSession, root: str, commits: list[Commit]) -> DataFrame:
    folders = [f"{root}/catalogue/{c.name}" for c in commits if c.entries]
    return spark.read.schema(_LOGGED).parquet(*folders) if folders else spark.createDataFrame([], _LOGGED)


def entries_at(spark: SparkSession, root: str, log: list[Commit]) -> DataFrame:
    """The entries after the commits of ``log``: the newest row of each tile."""
    live = [c for c in _since_whole(log) if c.entries]
    rows = _logged_entries(spark, root, live)
    if len(live) > 1:
        # Only what later commits wrote can be newer than a row; the first one is most of the catalogue.
        at = F.array_position(F.array(*[F.lit(c.name) for c in live]), F.col("commit"))
        later = _logged_entries(spark, root, live[1:]).groupBy("asset").agg(F.max(at).alias("_newest"))
        rows = rows.join(later, "asset", "left").where(F.col("_newest").isNull() | (F.col("_newest") == at))
    return rows.select(*[f.name for f in T.StructType.fromDDL(ENTRIES).fields])


def read_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """One row per stored tile, however many runs its rows came in; ``runs`` names them and ``run`` the last one."""
    return entries_at(spark, root, read_log(spark, root))


def read_batches(spark: SparkSession, root: str, log: list[Commit]) -> DataFrame:
    """What the commits since the last whole one have taken in."""
    folders = [f"{root}/batches/{c.name}" for c in _since_whole(log) if c.batches]
    return spark.read.schema(BATCHES).parquet(*folders) if folders else spark.createDataFrame([], BATCHES)


def commit_entries(spark: SparkSession, root: str, log: list[Commit], run: str | None = None, added: DataFrame | None = None, replaced: DataFrame | None = None,
                   batches: DataFrame | None = None, whole: bool = False) -> Commit:
    """Write entries and log them; the state they rest on is that of ``log``.

    ``added`` are entries of new rows, to be summed with those that are there; ``replaced`` take the place of what is there (the
    declared variables stay). ``whole`` replaces the catalogue by ``replaced``.
    """
    name = uuid.uuid4().hex
    held = entries_at(spark, root, log)
    columns = [f.name for f in T.StructType.fromDDL(ENTRIES).fields]
    rows = []
    if added is not None:
        summed = merged_entries(held, added) if log else added
        rows.append(summed.withColumn("run", F.element_at("runs", -1)).select(*columns))
    if replaced is not None:
        fresh = replaced if whole else replaced.join(held.select("asset", F.col("variables").alias("_declared")), "asset", "left").withColumn(
            "variables", F.array_sort(F.array_union("variables", F.coalesce("_declared", F.array().cast("array<string>")))))
        rows.append(fresh.withColumn("run", F.element_at("runs", -1)).select(*columns))
    if rows:
        folder = f"{root}/catalogue/{name}"
        reduce(DataFrame.unionByName, rows).withColumn("commit", F.lit(name)).write.parquet(folder)
    if batches is not None:
        batches.write.parquet(f"{root}/batches/{name}")
    seen = log[-1].number if log else 0
    while True:
        commit = Commit(seen + 1, name, run, bool(rows), batches is not None, whole)
        if _claim(spark, f"{root}/log", commit):
            return commit
        between = [c for c in read_log(spark, root) if c.number > seen]
        if any(c.whole for c in between) or whole:
            raise CommitConflict("the catalogue was rewritten meanwhile")
        if rows and between:
            mine = _logged_entries(spark, root, [commit]).select("asset")
            clash = _logged_entries(spark, root, between).join(mine, "asset", "left_semi").first()
            if clash is not None:
                raise CommitConflict(f"{clash.asset} was changed meanwhile")
        seen = max([seen + 1, *(c.number for c in between)])


def _claim(spark: SparkSession, folder: str, commit: Commit) -> bool:
    """Create the commit's file in the log, or say that its number is taken. PySpark has no create-if-absent of its own, so this
    is the one call of the Hadoop file system; it is atomic where that is (HDFS, and object stores with conditional writes)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{commit.number:020d}")
    try:
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error) or "already exists" in str(error):
            return False
        raise
    out.write(bytearray(json.dumps(vars(commit)).encode() + b"\n"))
    out.close()
    return True


def replace_catalogue(entries: DataFrame, root: str) -> None:
    """Make ``entries`` the whole catalogue, for example after a deletion. What was taken in before is forgotten, so that
    deleted tiles can be ingested again."""
    spark = entries.sparkSession
    commit_entries(spark, root, read_log(spark, root), replaced=entries, whole=True)


def committed_runs(spark: SparkSession, root: str) -> set[str]:
    """Runs that were ever committed, whether tiles still name them or not."""
    return {c.run for c in read_log(spark, root) if c.run}


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """Registered versions of the store's datasets; none before the first registration."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def register_version(spark: SparkSession, root: str, dataset: str, version: str) -> None:
    """Add the version if it is absent; a new one starts deprecated, as in :func:`absent_versions`."""
    absent = absent_versions(read_versions(spark, root), spark.createDataFrame([(dataset, version)], "dataset string, version string"))
    if not absent.isEmpty():
        absent.write.mode("append").parquet(f"{root}/versions")


def has_catalogue(spark: SparkSession, root: str) -> bool:
    return bool(read_log(spark, root))


def export_flat(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None) -> None:
    """Untiled export, one file per task."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if fmt in ("csv", "json"):
        # The default text format stops at milliseconds.
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_json_product(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
