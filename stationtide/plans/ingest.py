"""Ingestion: raw rows -> homogenised observations -> tiles -> catalogue, as one plan per run."""

from __future__ import annotations

from functools import reduce
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.config import DatasetConfig
from stationtide.functions.intervals import within
from stationtide.functions.tiles import asset_name
from stationtide.functions.times import period_start, ts
from stationtide.operators.catalogue import (
    IDENTITY, build_catalogue, content_columns, row_hash, tile_parts, tile_parts_of_wide, tile_status,
)
from stationtide.operators.codes import backfill_units, decode_units, define_units, units_of_variable
from stationtide.operators.homogenise import homogenise, missing_mandatory, select_model_columns
from stationtide.operators.quality import assert_period, validation_report
from stationtide.operators.reshape import columns_of_variable, melt_source
from stationtide.operators.tiling import TILE_KEYS, assign_dataset_tiles, declared_batches, gather_by_tile
from stationtide.plans.sanity import require_summary
from stationtide.session import BROADCAST_ROWS, broadcast_if_small, cut_lineage, smaller_partitions, staged, tidied
from stationtide.sources.store import (
    BATCHES, ENTRIES, LAYOUT, RUN_MARK, Commit, CommitConflict, commit_entries, entries_at, files_of, has_catalogue, listed_keys, new_run, parts_of, read_batches,
    read_catalogue, read_files, read_listed_tiles, read_log, read_tiles, register_version, write_manifest, write_parts, write_tiles,
)

#: Grain at which new and stored rows are compared.
GROUP = [*TILE_KEYS, "station", "variable", "day"]
#: How often an ingestion starts again after another writer got in between.
ATTEMPTS = 5
#: All rows that came, where a list of them is not needed.
ALL = object()


class IngestError(RuntimeError):
    """Stored tiles and new tiles contradict each other."""


def observations_of(raw: DataFrame, config: DatasetConfig, source: str, units: DataFrame | None = None,
                    period=None, gather: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Homogenised long observations with units. Narrow: the only joins are with code tables. ``gather`` brings the rows of a
    tile together first, while there is one row for all variables. ``wanted`` are parts (GROUP) that the rows of a melted source
    are cut to, also while there is one row for all variables."""
    definition = config.sources[source]
    rows = homogenise(raw, definition, config.space)
    if wanted is not None:
        rows = _of_parts(rows, config, source, wanted)
    if gather:
        rows = gather_by_tile(rows, config, source)
    if definition.melt:
        rows = melt_source(rows, definition)
    if wanted is not None:
        rows = rows.where(F.array_contains("_wanted", F.col("observed_variable"))).drop("_wanted")
    if period is not None:
        rows = assert_period(rows, *period)
    if "units" not in rows.columns:
        rows = define_units(rows, definition)
    return decode_units(rows, units) if units is not None else rows


def raw_period(config: DatasetConfig, source: str):
    """Start of the period of a raw row; rows without a time have none and belong to no tile."""
    return period_start(F.col(f"`{config.sources[source].raw_time_column}`").cast("timestamp_ntz"), config.time_tile_size)


def of_periods(raw: DataFrame, config: DatasetConfig, source: str, periods: list) -> DataFrame:
    """Raw rows of the listed periods; the list is bounded by the calendar."""
    return raw.where(raw_period(config, source).isin(periods))


def tiled_observations(raw: DataFrame, config: DatasetConfig, source: str, version: str,
                       graph=None, units: DataFrame | None = None, period=None, gather: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Observations with tile keys and identity columns, ready to be written."""
    rows = observations_of(raw, config, source, units, period, gather, wanted)
    if graph is not None:
        rows = select_model_columns(rows, graph)
    rows = rows.withColumns({"dataset": F.lit(config.name), "version": F.lit(version), "dataset_source": F.lit(source)})
    return assign_dataset_tiles(rows, config, source)


def _of_parts(rows: DataFrame, config: DatasetConfig, source: str, wanted: DataFrame) -> DataFrame:
    """Rows that are not melted yet, of the parts ``wanted``: ``_wanted`` lists the variables that are meant."""
    day = [*TILE_KEYS, "station", "day"]
    lists = wanted.groupBy(*[F.col(c).alias(f"_{c}") for c in day]).agg(F.collect_set("variable").alias("_wanted"))
    tiled = assign_dataset_tiles(rows.withColumn("dataset_source", F.lit(source)), config, source)
    tiled = tiled.withColumns({"station": F.col("primary_station_id").cast("string"), "day": F.col("report_timestamp").cast("date")})
    return tiled.join(broadcast_if_small(lists), _same(day, "_")).select(*[F.col(f"`{c}`") for c in rows.columns], "_wanted")


def parts_of_raw(raw: DataFrame, config: DatasetConfig, source: str, version: str, graph=None, units: DataFrame | None = None, by_day: bool = False) -> DataFrame:
    """:func:`tile_parts` of what ``raw`` turns into. Where a row turns into several, they are hashed while they are one row."""
    definition, tiled = config.sources[source], tiled_observations(raw, config, source, version, graph, units)
    rows = homogenise(raw, definition, config.space)
    own = {"station", "variable", "day", "dataset_source", "lat_size", "lon_size", *TILE_KEYS}
    if not definition.melt or units is not None or not set(definition.main_variables) <= set(definition.descriptions) or own & set(rows.columns):
        return tile_parts(tiled, by_day=by_day)
    content, cells = content_columns(tiled), {}
    for variable in sorted(definition.main_variables):
        found = columns_of_variable(rows, definition, variable)
        if "units" not in rows.columns:
            found |= units_of_variable(definition, variable, found["observation_value"])
        cells[variable] = {c: found.get(c, F.col(f"`{c}`")).cast(tiled.schema[c].dataType) for c in content}
    wide = assign_dataset_tiles(rows.withColumn("dataset_source", F.lit(source)), config, source)
    return tile_parts_of_wide(wide, cells, tiled, {"dataset": config.name, "version": version, "dataset_source": source}, by_day)


def raw_batches(raw: DataFrame, config: DatasetConfig, source: str, version: str, mark: str) -> DataFrame:
    """BATCHES: the rows of each period of ``raw`` as a count and an order-free sum of their hashes.

    ``mark`` stands for everything else that the stored rows depend on.
    """
    plain = [f.name for f in raw.schema.fields if f.dataType.typeName() != "map"]
    hashed = raw.select(raw_period(config, source).alias("batch_start"), row_hash(plain).alias("h")).where("batch_start IS NOT NULL")
    return hashed.groupBy("batch_start").agg(
        F.count(F.lit(1)).alias("n_raw"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("raw_low"), F.sum(F.shiftrightunsigned("h", 32)).alias("raw_high")
    ).select(F.lit(config.name).alias("dataset"), F.lit(version).alias("version"), F.lit(source).alias("dataset_source"), F.lit(mark).alias("mark"),
             "batch_start", "n_raw", "raw_low", "raw_high")


def _identified(df: DataFrame, config: DatasetConfig, source: str, version: str) -> DataFrame:
    return df.where((F.col("dataset") == config.name) & (F.col("version") == version) & (F.col("dataset_source") == source))


def ingest(spark: SparkSession, raw: DataFrame, config: DatasetConfig, source: str, version: str, root: str,
           graph=None, units: DataFrame | None = None, complete_batches: bool = False, on_change: str = "error", run: str | None = None) -> DataFrame:
    """Write what the store lacks of ``raw`` and return the entries of what was written, none for an empty batch.

    Periods that were taken in before with the same raw rows are left out once they are counted. Those without an entry are written whole.
    In the others new and stored rows are compared by content: parts (tile, station, variable, day) with the same number of
    rows and the same sum of row hashes hold the same; in the parts that differ, the rows whose observation id is not stored
    are written, be they many or few. A row without an id is known by its content.

    An id that comes back with other values is an error with ``on_change`` "error"; with "replace" the tile is written anew with
    the new row in place of the old one; with "keep" the stored row stays. ``complete_batches`` declares that a stored period
    was read whole, and skips it uncompared. ``run`` names the run, for callers that must find it again.

    The commit is the last step. If another writer has changed one of the same tiles meanwhile, the ingestion starts again
    on what is stored then.
    """
    if on_change not in ("error", "replace", "keep"):
        raise ValueError(f"on_change is {on_change!r}")
    for left in range(ATTEMPTS - 1, -1, -1):
        try:
            with tidied(spark, raw.sparkSession):
                return _ingest(spark, raw, config, source, version, root, graph, units, complete_batches, on_change, run or new_run())
        except CommitConflict:
            if not left:
                raise
    raise AssertionError


def _ingest(spark, raw, config, source, version, root, graph, units, complete_batches, on_change, run) -> DataFrame:
    log = read_log(spark, root)
    existing = entries_at(spark, root, log)
    own = _identified(existing, config, source, version)
    mark = f"{crc32(repr((config.sources[source], config.space_of(source), graph is not None, units is not None)).encode()):08x}"
    # Raw rows are counted, and those that are taken in are looked at several times: they are put together once for all passes.
    raw = staged(raw, "raw")
    # Periods are as many as the calendar has: their counts may pass the driver.
    came = raw_batches(raw, config, source, version, mark).collect()
    if not came:
        return nothing_written(spark, log, root, run)
    batches = spark.createDataFrame(came, BATCHES)
    known = {r.batch_start for r in read_batches(spark, root, log).join(F.broadcast(batches), batches.columns, "left_semi").collect()} if log else set()
    fresh = sorted(r.batch_start for r in came if r.batch_start not in known)
    start = F.col("time_coverage_start").cast("date")
    stored = {r.s for r in own.where(start.isin(fresh)).select(start.alias("s")).distinct().collect()} if log and fresh else set()
    new, old = [p for p in fresh if p not in stored], [p for p in fresh if p in stored and not complete_batches]
    if not new and not old:
        return nothing_written(spark, log, root, run)
    taken = batches.where(F.col("batch_start").isin(new + old))
    raw = of_periods(raw, config, source, new + old)
    pieces, apart, parts, rewritten = [], None, None, None
    if old:
        apart, late, rewritten = late_rows(spark, root, of_periods(raw, config, source, old), config, source, version, graph, units, cut_lineage(own.where(start.isin(old))), on_change)
        if apart is ALL:
            # Nothing of them was stored, as of months that a stored year lacked: they are like a new period.
            new, old, apart = new + old, [], None
        pieces = [] if apart is None else [apart]
        if late is not None:
            pieces.append(late.hint("rebalance", *[F.col(k) for k in TILE_KEYS]))
    if new:
        fresh = raw if not old else of_periods(raw, config, source, new)
        pieces.insert(0, tiled_observations(fresh, config, source, version, graph, units, gather=True))
        parts = parts_of_raw(fresh, config, source, version, graph, units, by_day=True)
    if not pieces:
        return nothing_written(spark, log, root, run, taken)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    identity = {"dataset": config.name, "version": version, "dataset_source": source}
    melted = (new or apart is not None) and config.sources[source].melt
    write_tiles(rows, root, run, identity, config.space_of(source), gathered=len(config.sources[source].main_variables) if melted else 1)
    return commit_run(spark, root, run, config.time_tile_size, list(config.sources[source].main_variables), log, rewritten, taken, parts, old)


def nothing_written(spark: SparkSession, log: list[Commit], root: str, run: str, taken: DataFrame | None = None) -> DataFrame:
    """No entries. What was taken in is logged, and so is a streamed run, which must not be taken for lost."""
    if taken is not None or run.startswith(RUN_MARK):
        commit_entries(spark, root, log, run, batches=taken)
    return spark.createDataFrame([], ENTRIES)


def late_rows(spark: SparkSession, root: str, raw: DataFrame, config: DatasetConfig, source: str, version: str, graph, units, own: DataFrame,
              on_change: str) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """(rows of parts that are not stored, other rows to write, tiles to be written anew with both) of ``raw`` against the entries
    ``own``; any may be None. The first rows are gathered by tile already, and ALL if no part of them is stored.

    Only parts that differ are read from the store, and of those only ids and hashes.
    """
    tiled = tiled_observations(raw, config, source, version, graph, units)
    sums = ("n_obs", "hash_low", "hash_high")
    came = staged(parts_of_raw(raw, config, source, version, graph, units, by_day=True).select(*GROUP, *sums), "came")
    held = parts_of(spark, root, listed_keys(own)).select(*GROUP, *sums)
    # Both sides are one aggregate: what came less what is held, and how much is held.
    sided = held.select(*GROUP, *[(-F.col(c)).alias(c) for c in sums], F.col("n_obs").alias("_held")).unionByName(came.withColumn("_held", F.lit(0).cast("bigint")))
    both = sided.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in sums], F.sum("_held").alias("_held"))
    differ = both.where((F.col("n_obs") + F.col("_held") > 0) & ((F.col("_held") == 0) | (F.col("n_obs") != 0) | (F.col("hash_low") != 0) | (F.col("hash_high") != 0)))
    differ = staged(differ.select(*GROUP, (F.col("_held") > 0).alias("_met")), "differ")
    n_parts = {r["_met"]: r["count"] for r in differ.groupBy("_met").count().collect()}
    if not n_parts:
        return None, None, None
    if True not in n_parts and n_parts[False] == came.count():
        return ALL, None, None
    content = content_columns(tiled)

    def rows_of(met: bool, gather: bool) -> DataFrame:
        wanted = differ.where(F.col("_met") == met).select(*GROUP)
        if config.sources[source].melt:
            return tiled_observations(raw, config, source, version, graph, units, gather=gather, wanted=wanted)
        named = _listed(wanted.withColumnsRenamed({c: f"_{c}" for c in GROUP}), n_parts[met])
        rows = _with_group(tiled).join(named, _same(GROUP, "_")).select(*tiled.columns)
        return rows.hint("rebalance", *[F.col(k) for k in TILE_KEYS]) if gather else rows

    # Rows of parts of which nothing is stored are new, but for ids that a part which differs holds.
    apart = rows_of(False, gather=True) if False in n_parts else None
    if True not in n_parts:
        return apart, None, None
    named_id = [*TILE_KEYS, "_id"]
    with_id = lambda rows: _with_id(rows.withColumn("_hash", row_hash(content)), content)
    met = _listed(differ.where("_met").select(*[F.col(c).alias(f"_{c}") for c in GROUP]), n_parts[True])
    tiles = met.select(*[f"_{c}" for c in TILE_KEYS]).distinct()
    kept = _with_group(_stored(spark, root, own.join(tiles, _entry_of("_"), "left_semi"), tiled, content)).join(met, _same(GROUP, "_"), "left_semi")
    # An id is stored once as a rule; where it has several contents, each of them counts as stored.
    known = staged(with_id(kept).select(*named_id, "_hash").repartition(*named_id).distinct().groupBy(*named_id).agg(F.collect_set("_hash").alias("_hashes")), "known")
    judged = with_id(rows_of(True, gather=False)).join(known, named_id, "left")
    if apart is not None:
        ids = broadcast_if_small(known.select(*named_id))
        moved = staged(with_id(rows_of(False, gather=False)).select(*named_id).join(ids, named_id, "left_semi").distinct(), "moved")
        if not moved.isEmpty():
            moved = broadcast_if_small(moved)
            judged = judged.unionByName(with_id(rows_of(False, gather=False)).join(moved, named_id, "left_semi").join(known, named_id, "left"))
            apart = with_id(apart).join(moved, named_id, "left_anti").select(*tiled.columns)
    state = F.when(F.col("_hashes").isNull(), "new").when(F.array_contains("_hashes", F.col("_hash")), "same").otherwise("changed")
    judged = staged(judged.withColumn("_state", state).where("_state <> 'same'").drop("_hashes"), "judged")
    found = {r["_state"]: r for r in judged.groupBy("_state").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("id"), F.min("time_start").alias("period")).collect()}
    if "changed" in found and on_change == "error":
        bad = found["changed"]
        raise IngestError(f"{bad.n} stored observations came with other values, observation {bad.id} for one; the first is of the period {bad.period}")
    fresh = judged.where("_state = 'new'").select(*tiled.columns) if "new" in found else None
    if "changed" not in found or on_change == "keep":
        return apart, fresh, None
    changed = judged.where("_state = 'changed'")
    again = cut_lineage(changed.select(*TILE_KEYS).distinct())
    whole = _stored(spark, root, own.join(again.withColumnsRenamed({c: f"_{c}" for c in TILE_KEYS}), _entry_of("_"), "left_semi"), tiled, content)
    rest = with_id(whole).join(changed.select(*named_id).distinct(), named_id, "left_anti").drop("_id", "_hash", "run")
    return apart, judged.select(*tiled.columns).unionByName(rest, allowMissingColumns=True), again


def _listed(parts: DataFrame, n: int) -> DataFrame:
    """A list whose rows were counted: broadcast within the bound."""
    return F.broadcast(parts) if n <= BROADCAST_ROWS else parts


def _stored(spark: SparkSession, root: str, entries: DataFrame, like: DataFrame, content: list[str]) -> DataFrame:
    """Stored rows of the entries, with null for columns that they lack."""
    rows = read_files(spark, root, files_of(spark, root, entries))
    return rows.withColumns({c: F.lit(None).cast(like.schema[c].dataType) for c in content if c not in rows.columns})


def _same(columns: list[str], prefix: str):
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns))


def _entry_of(prefix: str):
    """The entry of a tile whose keys have a prefix."""
    return ((F.col("time_coverage_start").cast("date") == F.col(f"{prefix}time_start")) & (F.col("latitude_coverage_start").cast("int") == F.col(f"{prefix}lat_start"))
            & (F.col("longitude_coverage_start").cast("int") == F.col(f"{prefix}lon_start")))


def _with_group(tiled: DataFrame) -> DataFrame:
    return tiled.withColumns({"station": F.col("primary_station_id").cast("string"), "variable": F.col("observed_variable").cast("string"),
                              "day": F.col("report_timestamp").cast("date")})


def _with_id(rows: DataFrame, content: list[str]) -> DataFrame:
    """The id that a row is known by: its own, or its content."""
    mark = F.concat(F.lit("content "), F.hex("_hash"))
    return rows.withColumn("_id", F.coalesce(F.col("observation_id").cast("string"), mark) if "observation_id" in content else mark)


def run_entries(spark: SparkSession, root: str, run: str, time_size: str, declared_variables=None, known: DataFrame | None = None, rest: list = ()) -> DataFrame:
    """Entries of the tiles of a run: its parts and its manifest are written first.

    ``known`` are the parts of all tiles but those of the periods ``rest``. The stored rows are hashed for the others alone;
    what is known must agree with the files in the number of rows.
    """
    stored = read_tiles(spark, root, [run]).drop("run")
    if known is None:
        parts = tile_parts(stored, by_day=True)
    else:
        parts = known.unionByName(tile_parts(stored.where(F.col("time_start").isin(rest)), by_day=True)) if rest else known
    parts = write_parts(parts, root, run)
    files = write_manifest(spark, root, run)
    entries = build_catalogue(parts, time_size, declared_variables=declared_variables)
    if known is not None:
        n_parts, n_rows = parts.agg(F.sum("n_obs")).first()[0], files.agg(F.sum("n_rows")).first()[0]
        if n_parts != n_rows:
            raise IngestError(f"{n_rows} rows were stored of {n_parts} that came")
    sizes = files.groupBy(*LAYOUT).agg(F.sum("bytes").alias("file_size"))
    return with_file_size(entries, sizes).withColumns({"runs": F.array(F.lit(run)), "run": F.lit(run)})


def commit_run(spark: SparkSession, root: str, run: str, time_size: str, declared_variables=None, log: list[Commit] | None = None,
               rewritten: DataFrame | None = None, batches: DataFrame | None = None, known: DataFrame | None = None, rest: list = ()) -> DataFrame:
    """List the tiles of a run: parts and manifest first, the catalogue last. ``rewritten`` tiles (TILE_KEYS) take the place of what
    is stored of them, the others add to it. Returns the entries of the run alone. ``known`` and ``rest`` are as in :func:`run_entries`."""
    entries = run_entries(spark, root, run, time_size, declared_variables, known, rest)
    log = read_log(spark, root) if log is None else log
    if rewritten is None:
        commit_entries(spark, root, log, run, added=entries, batches=batches)
    else:
        tiles = broadcast_if_small(rewritten.withColumnsRenamed({c: f"_{c}" for c in TILE_KEYS}))
        commit_entries(spark, root, log, run, added=entries.join(tiles, _entry_of("_"), "left_anti"), replaced=entries.join(tiles, _entry_of("_"), "left_semi"), batches=batches)
    return entries


def with_file_size(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add the stored bytes of each tile."""
    keyed = sizes.select(
        *IDENTITY, F.col("time_start").cast("timestamp_ntz").alias("time_coverage_start"),
        F.col("lat_start").cast("double").alias("latitude_coverage_start"),
        F.col("lon_start").cast("double").alias("longitude_coverage_start"), "file_size",
    )
    return entries.join(keyed, IDENTITY + ["time_coverage_start", "latitude_coverage_start", "longitude_coverage_start"])


def compact(spark: SparkSession, root: str, time_size: str, target_bytes: int = 128 << 20, keep_commits: int = 20) -> DataFrame:
    """Write the small pieces of tiles that several runs hold into one run, and return the entries that changed.

    Of a tile, the runs whose files there are smaller than ``target_bytes`` are read and written together; larger ones stay
    where they are. Pieces of streams and others are packed apart, so that both can still be told from each other. The new
    run takes their place in one commit; whoever has read the catalogue before goes on reading the old files. A catalogue
    of more than ``keep_commits`` commits is folded into one.
    """
    log = read_log(spark, root)
    entries = entries_at(spark, root, log)
    files = files_of(spark, root, entries)
    lane = F.col("run").startswith(RUN_MARK)
    pieces = files.groupBy("run", *LAYOUT).agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") < target_bytes).withColumn("_lane", lane)
    crowded = pieces.groupBy(*LAYOUT, "_lane").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    chosen = cut_lineage(pieces.join(crowded, [*LAYOUT, "_lane"], "left_semi").select("run", *LAYOUT, "_lane"))
    changed = None
    for streamed in (False, True):
        lane_pieces = chosen.where(F.col("_lane") == streamed).drop("_lane")
        if lane_pieces.isEmpty():
            continue
        run = (RUN_MARK if streamed else "") + new_run()
        own = broadcast_if_small(lane_pieces)
        rows = read_files(spark, root, files.join(own, own.columns, "left_semi")).drop("run")
        write_tiles(rows, root, run)
        fresh = run_entries(spark, root, run, time_size)
        n_before = files.join(own, own.columns, "left_semi").agg(F.sum("n_rows")).first()[0]
        if fresh.agg(F.sum("n_obs")).first()[0] != n_before:
            raise IngestError("the packed run does not hold the rows of its pieces")
        # The entry of a tile stays what it is but for the runs that hold it and their bytes.
        packed = _by_asset(lane_pieces, time_size).groupBy("asset").agg(F.collect_set("run").alias("_old"))
        bytes_of = _by_asset(files, time_size).groupBy("asset", "run").agg(F.sum("bytes").alias("b")).join(packed, "asset").where(F.array_contains("_old", F.col("run")))
        freed = bytes_of.groupBy("asset").agg(F.sum("b").alias("_freed"))
        now = entries_at(spark, root, log).join(packed, "asset").join(freed, "asset").join(fresh.select("asset", F.col("file_size").alias("_new")), "asset")
        moved = now.withColumns({"runs": F.concat(F.array_except("runs", "_old"), F.array(F.lit(run))), "run": F.lit(run), "file_size": F.col("file_size") - F.col("_freed") + F.col("_new")})
        commit = commit_entries(spark, root, log, run, replaced=cut_lineage(moved.select(*entries.columns)))
        log = [*log, commit] if commit.number == (log[-1].number if log else 0) + 1 else read_log(spark, root)
        ours = entries_at(spark, root, log).where(F.array_contains("runs", run))
        changed = ours if changed is None else changed.unionByName(ours)
    if len(log) > keep_commits:
        fold_log(spark, root)
    return changed if changed is not None else entries.where("false")


def _by_asset(keyed: DataFrame, time_size: str) -> DataFrame:
    return keyed.withColumn("asset", asset_name(F.col("dataset"), F.col("version"), F.col("dataset_source"), F.col("time_start"), time_size, F.col("lat_start"), F.col("lon_start")))


def fold_log(spark: SparkSession, root: str) -> Commit:
    """One commit that holds all entries and batches, so that readers need not put the catalogue together."""
    log = read_log(spark, root)
    return commit_entries(spark, root, log, replaced=entries_at(spark, root, log), batches=read_batches(spark, root, log).distinct(), whole=True)


def save_tiles(spark: SparkSession, tiled: DataFrame, config: DatasetConfig, source: str, version: str, root: str) -> DataFrame:
    """Tile-level save: identical tiles are skipped, different ones are an error, new ones are written."""
    log = read_log(spark, root)
    entries = build_catalogue(tile_parts(tiled), config.time_tile_size)
    status = cut_lineage(tile_status(entries, entries_at(spark, root, log)))
    clash = status.where(F.col("status") == "exists_different").first()
    if clash is not None:
        raise IngestError(f"{clash.asset} is stored with different content")
    new = status.where(F.col("status") == "new").select(
        *IDENTITY, F.col("time_coverage_start").cast("date").alias("time_start"),
        F.col("latitude_coverage_start").cast("int").alias("lat_start"),
        F.col("longitude_coverage_start").cast("int").alias("lon_start"),
    )
    if not new.isEmpty():
        run = new_run()
        rows = tiled.join(broadcast_if_small(new), IDENTITY + TILE_KEYS, "left_semi")
        write_tiles(rows, root, run, {"dataset": config.name, "version": version, "dataset_source": source}, config.space_of(source))
        commit_run(spark, root, run, config.time_tile_size, log=log)
    return status


def ingest_declared(spark: SparkSession, raw: DataFrame, config: DatasetConfig, source: str, version: str, root: str,
                    start_year: int, end_year: int, start_month: int = 1, graph=None, units: DataFrame | None = None) -> DataFrame:
    """Ingest the batches of a span of years: (batch_start, batch_end, status, n_obs) for each of them.

    A declared batch is read whole, so one that is ``stored`` is skipped unread; the others are ``written`` or ``empty``. All
    are one plan over the rows of the span, not a job each. The version is registered first, and afterwards the store must
    pass the summary check.
    """
    register_version(spark, root, config.name, version)
    batches = declared_batches(spark, start_year, end_year, start_month, config.time_tile_size)
    ends = batches.agg(F.min("batch_start").alias("a"), F.max("batch_end").alias("b")).first()
    own = (F.col("dataset") == config.name) & (F.col("version") == version) & (F.col("dataset_source") == source)
    per_batch = lambda entries: entries.where(own).groupBy(F.col("time_coverage_start").cast("date").alias("batch_start")).agg(
        F.sum("n_obs").alias("n"))
    # Fixed before this run adds to the catalogue.
    before = cut_lineage(per_batch(read_catalogue(spark, root))).withColumnRenamed("n", "held")
    span = raw.where(within(F.col(config.sources[source].raw_time_column), ts(str(ends.a)), ts(str(ends.b))))
    entries = ingest(spark, span, config, source, version, root, graph, units, complete_batches=True)
    report = batches.join(per_batch(entries), "batch_start", "left")
    report = report.join(before, "batch_start", "left")
    if has_catalogue(spark, root):
        require_summary(read_catalogue(spark, root).where(own), config.sources[source].main_variables)
    status = F.when(F.col("held").isNotNull(), "stored").when(F.col("n").isNotNull(), "written").otherwise("empty")
    return report.select("batch_start", "batch_end", status.alias("status"), F.coalesce("held", "n", F.lit(0)).alias("n_obs"))


def dry_run(raw: DataFrame, config: DatasetConfig, source: str, version: str, graph=None,
            units: DataFrame | None = None) -> DataFrame:
    """The catalogue an ingestion would produce, without writing anything."""
    return build_catalogue(parts_of_raw(raw, config, source, version, graph, units), config.time_tile_size)


def make_cdm(raw: DataFrame, config: DatasetConfig, source: str, graph, codes: DataFrame, save_to: str | None = None) -> DataFrame:
    """Homogenise one batch and validate it: (check, item, n_rows) of everything that breaks the model.

    ``unknown_column`` is no field of the model, ``type`` has another kind than declared, ``primary_key`` is null, and
    ``variable`` or ``units`` are not in the code table. ``save_to`` also writes the rows, untiled; the checks then read what
    was written.
    """
    rows = observations_of(raw, config, source)
    if save_to is not None:
        definition = config.sources[source]
        # Ids do not repeat: a dictionary of them would be begun and given up in every file.
        with smaller_partitions(raw.sparkSession, len(definition.main_variables) if definition.melt else 1):
            rows.write.mode("overwrite").option("parquet.enable.dictionary#observation_id", "false").parquet(save_to)
        rows = raw.sparkSession.read.schema(rows.schema).parquet(save_to)
    return validation_report(rows, graph, codes)


def batch_is_stored(catalogue: DataFrame, dataset: str, source: str, version: str, start, end,
                    box=(-180, 180, -90, 90)) -> bool:
    """Is there an entry for exactly this period inside the box?"""
    lon_start, lon_end, lat_start, lat_end = box
    return not catalogue.where(
        (F.col("dataset") == dataset) & (F.col("dataset_source") == source) & (F.col("version") == version)
        & (F.col("time_coverage_start") == start) & (F.col("time_coverage_end") == end)
        & (F.col("longitude_coverage_start") >= lon_start) & (F.col("longitude_coverage_end") <= lon_end)
        & (F.col("latitude_coverage_start") >= lat_start) & (F.col("latitude_coverage_end") <= lat_end)
    ).isEmpty()


def preparation_warnings(raw: DataFrame, config: DatasetConfig, source: str) -> list[str]:
    definition = config.sources[source]
    renamed = [definition.rename.get(c, c) for c in raw.columns]
    missing = missing_mandatory(raw.toDF(*renamed), definition)
    return [f"mandatory column {c} is missing" for c in missing]


def backfill_stored_units(spark: SparkSession, root: str, units: DataFrame, time_size: str) -> DataFrame:
    """Rewrite stored tiles whose units still are numeric codes; tiles with names are left alone.

    The rewritten tiles are a new run. The catalogue then names it in place of
    the old ones, with the new sizes and checksums.
    """
    log = read_log(spark, root)
    entries = entries_at(spark, root, log)
    tiles = read_files(spark, root, files_of(spark, root, entries))
    stale = cut_lineage(tiles.where(F.col("units").rlike(r"^\d+$")).select(*IDENTITY, *TILE_KEYS).distinct())
    if stale.isEmpty():
        return entries.where("false")
    run = new_run()
    write_tiles(backfill_units(tiles.join(broadcast_if_small(stale), stale.columns, "left_semi").drop("run"), units), root, run)
    commit_entries(spark, root, log, run, replaced=run_entries(spark, root, run, time_size))
    return read_catalogue(spark, root).where(F.col("run") == run)
