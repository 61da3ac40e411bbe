from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationtide.config import ConfigError, DatasetConfig, Description, SourceConfig, SpaceColumns
from stationtide.operators.catalogue import tile_parts, build_catalogue
from stationtide.operators.tiling import assign_tiles, declared_batches, space_batches
from stationtide.plans import ingest as ingestion
from stationtide.plans.ingest import IngestError, backfill_stored_units, commit_run, compact, fold_log, ingest, save_tiles, tiled_observations
from stationtide.plans.products import form_choices, statistics
from stationtide.plans.retrieve import NoDataFound, Request, request_entries, require_entries, resolve_version, retrieve_from_store, retrieve_rows, retrieve_stored, write_result
from stationtide.plans.sanity import require_summary
from stationtide.sources.store import (
    CommitConflict, files_of, new_run, read_catalogue, read_listed_tiles, read_log, read_parts, read_tiles, replace_catalogue, stored_sizes, write_tiles,
)
from stationtide.streaming.incremental import open_file_stream, read_stream_catalogue, read_stream_tiles, stream_tiles

RAW = "report_timestamp timestamp_ntz, primary_station_id string, latitude double, longitude double, observation_id string, observed_variable string, observation_value double"


def config(**changes):
    source = SourceConfig(main_variables=("t", "p"), descriptions={
        "report_timestamp": Description("datetime64[ns]"), "t": Description("float64", units="K"), "p": Description("float64", units="Pa")})
    return DatasetConfig(**{**dict(name="sondes", sources={"01": source}, lat_tile_size=90, lon_tile_size=180,
                                   space=SpaceColumns("longitude", "latitude")), **changes})


def raw_rows(months=(1, 2), n=12):
    """Rows spread over the globe, both edges included."""
    out = []
    for month in months:
        for i in range(n):
            lat = 90.0 if i == 0 else -90.0 + 15 * i
            lon = 180.0 if i < 2 else -180.0 + 30 * i
            at = datetime(2020, month, 1) + timedelta(days=(i * 7) % 28, hours=i)
            out.append((at, f"s{i % 4}", lat, lon, f"{month}-{i}", "t" if i % 2 else "p", float(i)))
    return out


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def ids(df):
    return sorted(r.observation_id for r in df.select("observation_id").collect())


def test_ingest_is_incremental(spark, frame, root):
    first = ingest(spark, frame(raw_rows((1,)), RAW), config(), "01", "1.0.0", root)
    n_first = first.count()
    assert n_first > 0
    second = ingest(spark, frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0", root)
    assert {r.time_coverage_start for r in second.collect()} == {datetime(2020, 2, 1)}
    assert ingest(spark, frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0", root).count() == 0
    # Another version is another set of batches.
    assert ingest(spark, frame(raw_rows((1,)), RAW), config(), "01", "2.0.0", root).count() == n_first
    entries = read_catalogue(spark, root)
    assert entries.select("asset").distinct().count() == entries.count()
    rows = read_listed_tiles(spark, root).where("version = '1.0.0'")
    assert ids(rows) == sorted(r[4] for r in raw_rows((1, 2)))
    # Identity values that look like numbers come back as text.
    assert rows.select("dataset_source").distinct().first()[0] == "01"
    assert entries.agg(F.sum("n_obs")).first()[0] == 36 and entries.where("file_size <= 0").count() == 0
    require_summary(entries, ("t", "p"))


def test_ingest_by_space_fills_single_tiles(spark, frame, root):
    by_space = config(read_by_space=True)
    north = [r for r in raw_rows((1,)) if r[2] >= 0]
    ingest(spark, frame(north, RAW), by_space, "01", "1.0.0", root)
    ingest(spark, frame(raw_rows((1,)), RAW), by_space, "01", "1.0.0", root)
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1,)))


def test_a_run_that_died_is_not_read(spark, frame, root):
    ingest(spark, frame(raw_rows((1,)), RAW), config(), "01", "1.0.0", root)
    lost = tiled_observations(frame(raw_rows((2,)), RAW), config(), "01", "1.0.0")
    write_tiles(lost, root, new_run(), {"dataset": "sondes", "version": "1.0.0", "dataset_source": "01"})
    assert read_tiles(spark, root).count() == 24 and read_listed_tiles(spark, root).count() == 12
    ingest(spark, frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0", root)
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2)))
    assert read_parts(spark, root).agg(F.sum("n_obs")).first()[0] == 24


def test_tiles_are_stored_in_order(spark, frame, root):
    rows = raw_rows((1,), 12) * 1
    shuffled = frame(rows[::-1], RAW).withColumns({"dataset": F.lit("d"), "version": F.lit("1.0.0"), "dataset_source": F.lit("s")})
    write_tiles(assign_tiles(shuffled, 180, 360), root, "r1", {"dataset": "d", "version": "1.0.0", "dataset_source": "s"})
    for path in read_tiles(spark, root).inputFiles():
        times = [r.report_timestamp for r in spark.read.parquet(path).collect()]
        assert times == sorted(times)


def test_save_tiles_knows_identical_and_different(spark, frame, root):
    tiled = tiled_observations(frame(raw_rows((1,)), RAW), config(), "01", "1.0.0")
    status = lambda df: {r.status for r in save_tiles(spark, df, config(), "01", "1.0.0", root).collect()}
    assert status(tiled) == {"new"} and status(tiled) == {"exists_identical"}
    assert read_listed_tiles(spark, root).count() == 12
    with pytest.raises(IngestError):
        save_tiles(spark, tiled.withColumn("observation_value", F.col("observation_value") + 1), config(), "01", "1.0.0", root)
    # Column order and row order do not change the content hash.
    turned = tiled.select(*sorted(tiled.columns)).orderBy(F.desc("observation_id"))
    assert status(turned) == {"exists_identical"}


def test_stored_sizes_list_files(spark, frame, root):
    ingest(spark, frame(raw_rows((1,)), RAW), config(), "01", "1.0.0", root)
    assert stored_sizes(spark, root).count() == read_catalogue(spark, root).count()


REQUESTS = [
    Request(),
    Request(latitude_coverage=(60.0, 90.0)),
    Request(longitude_coverage=(0.0, 180.0), variables=("t",)),
    Request(latitude_coverage=(-45.0, 45.0), longitude_coverage=(-90.0, 100.0), time_coverage=("2020-01-10", "2020-02-05")),
    Request(year=(2020,), month=(2,), day=(1, 8)),
    Request(stations=("s1", "s3"), year=(2020,)),
]


@pytest.mark.parametrize("time_size", ["month", "year"])
def test_retrieval_equals_a_full_scan(spark, frame, root, time_size):
    cfg = config(time_tile_size=time_size)
    raw = frame(raw_rows((1, 2)), RAW)
    ingest(spark, raw, cfg, "01", "1.0.0", root)
    entries = read_catalogue(spark, root)
    versions = entries.select("dataset", "version").distinct().withColumn("deprecated", F.lit(False))
    for request in REQUESTS:
        got = retrieve_from_store(read_tiles(spark, root), entries, versions, "sondes", request, time_size)
        assert ids(got) == ids(retrieve_rows(raw, request)), request
        found = request_entries(entries, versions, "sondes", request)
        assert found.count() > 0
    assert resolve_version(versions, "sondes") == "1.0.0"
    with pytest.raises(NoDataFound):
        resolve_version(versions, "other")
    with pytest.raises(NoDataFound):
        require_entries(request_entries(entries, versions, "sondes", Request(variables=("ozone",))))
    # The edge rows are among the results of a request that ends on the edge.
    assert "1-0" in ids(retrieve_rows(raw, REQUESTS[1]))


def test_partition_keys_prune_the_scan(spark, frame, root):
    ingest(spark, frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0", root)
    request = Request(latitude_coverage=(-90.0, -10.0), time_coverage=("2020-02-01", "2020-03-01"))
    pruned = read_tiles(spark, root).where(request.tile_condition("month"))
    assert set(map(tuple, pruned.select("time_start", "lat_start").distinct().collect())) == {(date(2020, 2, 1), -90)}
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_result_formats(spark, frame, tmp_path):
    rows = frame(raw_rows((1,)), RAW)
    write_result(rows, Request(format="csv"), str(tmp_path / "c"))
    write_result(rows, Request(format="netCDF"), str(tmp_path / "p"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == spark.read.parquet(str(tmp_path / "p")).count() == 12
    with pytest.raises(ValueError):
        Request(format="xml")
    with pytest.raises(ValueError):
        Request(version="newest")
    with pytest.raises(ValueError):
        Request(time_coverage=("2020-01-02", "2020-01-01"))
    with pytest.raises(ValueError):
        Request(time_coverage=("2020-01-01", "2020-01-02"), year=(2020,))


def test_catalogue_can_be_rewritten(spark, frame, root):
    ingest(spark, frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0", root)
    entries = read_catalogue(spark, root)
    replace_catalogue(entries.where(F.month("time_coverage_start") == 1), root)
    assert {r.time_coverage_start.month for r in read_catalogue(spark, root).collect()} == {1}
    # Tiles that are no longer listed are no longer read.
    assert {r.report_timestamp.month for r in read_listed_tiles(spark, root).collect()} == {1}
    assert read_parts(spark, root).agg(F.sum("n_obs")).first()[0] == 12


def test_stored_units_are_backfilled_once(spark, frame, root):
    codes = frame([(5, "K"), (32, "Pa")], "code int, abbreviation string")
    raw = frame(raw_rows((1, 2)), RAW).withColumn("units", F.when(F.month("report_timestamp") == 1, "5").otherwise("Pa"))
    ingest(spark, raw, config(), "01", "1.0.0", root)
    before = {r.asset: r.file_checksum for r in read_catalogue(spark, root).collect()}
    fixed = backfill_stored_units(spark, root, codes, "month")
    assert {r.time_coverage_start.month for r in fixed.collect()} == {1}
    rows = read_listed_tiles(spark, root)
    assert {(r.report_timestamp.month, r.units) for r in rows.collect()} == {(1, "K"), (2, "Pa")} and rows.count() == 24
    after = {r.asset: r.file_checksum for r in read_catalogue(spark, root).collect()}
    assert after.keys() == before.keys() and all((after[a] != before[a]) == ("_202001_" in a) for a in after)
    assert read_parts(spark, root).agg(F.sum("n_obs")).first()[0] == 24
    assert backfill_stored_units(spark, root, codes, "month").count() == 0


def test_products_of_a_catalogue(spark, frame):
    tiled = tiled_observations(frame(raw_rows((1, 12)), RAW), config(), "01", "1.0.0")
    entries = build_catalogue(tile_parts(tiled), "month")
    stats = {(r.metric, r.value) for r in statistics(entries).collect()}
    assert ("number of stations", "4") in stats and ("time coverage end", "2021-01-01") in stats and ("variable", "p") in stats
    widgets = {(r.widget, r.value) for r in form_choices(entries).collect()}
    # The coverage ends on 1 January 2021, so 2021 is not offered.
    assert {v for w, v in widgets if w == "year"} == {"2020"}
    assert ("month", "01") in widgets and ("day", "31") in widgets and ("dataset_source", "01") in widgets


def test_declared_batches(spark):
    months = [r.batch_start for r in declared_batches(spark, 2000, 2001, 11).orderBy("batch_start").collect()]
    assert months[0] == date(2000, 11, 1) and months[-1] == date(2001, 12, 1) and len(months) == 14
    years = declared_batches(spark, 2000, 2001, 11, "year").orderBy("batch_start")
    assert [tuple(r) for r in years.collect()] == [(date(2000, 1, 1), date(2001, 1, 1)), (date(2001, 1, 1), date(2002, 1, 1))]
    tiles = space_batches(years, 90, 180)
    assert tiles.count() == 2 * 2 * 2 and tiles.agg(F.max("lon_end")).first()[0] == 180


def test_stream_equals_batch(spark, frame, tmp_path, root):
    source = str(tmp_path / "in")
    # Three files and three micro-batches; tiles get rows from several of them.
    for i in range(3):
        frame(raw_rows((1, 2))[i::3], RAW).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = open_file_stream(spark, source, schema, "*.parquet", files_per_batch=1)
    stream_tiles(stream, config(), "01", "1.0.0", root).awaitTermination()
    assert ids(read_stream_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2)))
    batch = build_catalogue(tile_parts(tiled_observations(frame(raw_rows((1, 2)), RAW), config(), "01", "1.0.0")), "month")
    streamed = read_stream_catalogue(spark, root, "month")
    columns = ["asset", "n_obs", "stations", "variables", "file_checksum", "data_size"]
    assert sorted(map(tuple, streamed.select(columns).collect())) == sorted(map(tuple, batch.select(columns).collect()))
    # A restart finds nothing new.
    stream_tiles(open_file_stream(spark, source, schema, "*.parquet"), config(), "01", "1.0.0", root).awaitTermination()
    assert read_stream_tiles(spark, root).count() == 24


def test_streams_of_two_sources_and_a_lost_checkpoint(spark, frame, tmp_path, root):
    """Each source has its own progress, streamed tiles are in the catalogue, and a new checkpoint overwrites nothing."""
    two = config(sources={"01": config().sources["01"], "02": config().sources["01"]})
    schema = None
    for source, months in (("01", (1,)), ("02", (2,))):
        folder = str(tmp_path / source)
        frame(raw_rows(months), RAW).coalesce(1).write.parquet(folder)
        schema = schema or spark.read.parquet(folder).schema
        stream_tiles(open_file_stream(spark, folder, schema, "*.parquet"), two, source, "1.0.0", root).awaitTermination()
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2)))
    runs = {r.run for r in read_catalogue(spark, root).select("run").distinct().collect()}
    assert len(runs) == 2 and not any("None" in r for r in runs)
    later = str(tmp_path / "later")
    frame(raw_rows((3,)), RAW).coalesce(1).write.parquet(later)
    (tmp_path / "store" / "stream" / "sondes-1.0.0-01").rename(tmp_path / "gone")
    stream_tiles(open_file_stream(spark, later, schema, "*.parquet"), two, "01", "1.0.0", root).awaitTermination()
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2, 3)))


def test_late_and_empty_batches(spark, frame, root):
    rows = raw_rows((1, 2))
    assert ingest(spark, frame([], RAW), config(), "01", "1.0.0", root).count() == 0
    ingest(spark, frame(rows[:7], RAW), config(), "01", "1.0.0", root)
    late = ingest(spark, frame(rows, RAW), config(), "01", "1.0.0", root)
    assert late.agg(F.sum("n_obs")).first()[0] == len(rows) - 7
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in rows)
    assert ingest(spark, frame(rows, RAW), config(), "01", "1.0.0", root).count() == 0
    assert ingest(spark, frame([], RAW), config(), "01", "1.0.0", root).count() == 0
    # A declared batch is not read again.
    more = rows + [(datetime(2020, 1, 5), "s9", 0.0, 0.0, "extra", "t", 1.0)]
    assert ingest(spark, frame(more, RAW), config(), "01", "1.0.0", root, complete_batches=True).count() == 0
    assert ingest(spark, frame(more, RAW), config(), "01", "1.0.0", root).count() == 1


def test_sources_with_unlike_columns(spark, frame, root):
    two = config(sources={"01": config().sources["01"], "02": config().sources["01"]})
    ingest(spark, frame(raw_rows((1,)), RAW), two, "01", "1.0.0", root)
    ingest(spark, frame(raw_rows((1,)), RAW).withColumn("quality_flag", F.lit(2)), two, "02", "1.0.0", root)
    versions = frame([("sondes", "1.0.0", False)], "dataset string, version string, deprecated boolean")
    first, second = (retrieve_stored(spark, root, versions, "sondes", Request(dataset_source=s, version="1.0.0"), "month") for s in ("01", "02"))
    assert first.count() == second.count() == 12
    assert {r.quality_flag for r in second.select("quality_flag").collect()} == {2}
    with pytest.raises(NoDataFound):
        retrieve_stored(spark, root, versions, "sondes", Request(version="1.0.0", year=(1950,)), "month")
    # Only folders of runs that the entries name are opened.
    runs = {f.split("/run=")[1].split("/")[0] for f in second.inputFiles() if "/tiles/" in f}
    named = read_catalogue(spark, root).where("dataset_source = '02'").select("run").distinct().collect()
    assert runs == {r.run for r in named}
    ingest(spark, frame(raw_rows((2,)), RAW).withColumn("quality_flag", F.lit("bad")), two, "01", "1.0.0", root)
    with pytest.raises(ConfigError, match="quality_flag"):
        read_listed_tiles(spark, root)


def test_hash_sees_where_nulls_are(frame):
    from stationtide.operators.catalogue import row_hash

    rows = frame([(None, 1), (1, None), (None, None), (1, 1)], "a int, b int").select(row_hash(["a", "b"]).alias("h")).collect()
    assert len({r.h for r in rows}) == 4


def values(spark, root):
    return sorted((r.observation_id, r.observation_value) for r in read_listed_tiles(spark, root).collect())


def test_a_delta_smaller_than_its_tiles_is_kept(spark, frame, root):
    rows = raw_rows((1, 2, 3), 30)
    yearly = config(time_tile_size="year")
    ingest(spark, frame(rows[:-7], RAW), yearly, "01", "1.0.0", root)
    late = ingest(spark, frame(rows[-7:], RAW), yearly, "01", "1.0.0", root)
    assert late.agg(F.sum("n_obs")).first()[0] == 7 and ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in rows)
    # Parts that overlap with what is stored, in any mixture.
    for part in (rows[5:9] + rows[-3:], rows[::2], rows):
        assert ingest(spark, frame(part, RAW), yearly, "01", "1.0.0", root).count() == 0
    # One entry for each tile, equal to that of all rows at once.
    entries = read_catalogue(spark, root)
    whole = build_catalogue(tile_parts(tiled_observations(frame(rows, RAW), yearly, "01", "1.0.0")), "year")
    columns = ["asset", "n_obs", "stations", "file_checksum", "data_size"]
    assert sorted(map(tuple, entries.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))
    assert {r.metric: r.value for r in statistics(entries).collect()}["number of partitions"] == str(whole.count())


def test_changed_values_raise_or_replace(spark, frame, root):
    rows = raw_rows((1,))
    ingest(spark, frame(rows, RAW), config(), "01", "1.0.0", root)
    changed = [r if i != 3 else (*r[:6], 99.0) for i, r in enumerate(rows)]
    more = changed + [(datetime(2020, 1, 5), "s9", 0.0, 0.0, "extra", "t", 1.0)]
    with pytest.raises(IngestError, match=rows[3][4]):
        ingest(spark, frame(more, RAW), config(), "01", "1.0.0", root)
    assert values(spark, root) == sorted((r[4], r[6]) for r in rows)
    assert ingest(spark, frame(changed, RAW), config(), "01", "1.0.0", root, on_change="keep").count() == 0
    ingest(spark, frame(more, RAW), config(), "01", "1.0.0", root, on_change="replace")
    assert values(spark, root) == sorted((r[4], r[6]) for r in more)
    entries = read_catalogue(spark, root)
    assert entries.agg(F.sum("n_obs")).first()[0] == 13 == read_parts(spark, root).agg(F.sum("n_obs")).first()[0]
    whole = build_catalogue(tile_parts(tiled_observations(frame(more, RAW), config(), "01", "1.0.0")), "month")
    assert {(r.asset, r.file_checksum) for r in entries.collect()} == {(r.asset, r.file_checksum) for r in whole.collect()}
    with pytest.raises(ValueError):
        ingest(spark, frame(more, RAW), config(), "01", "1.0.0", root, on_change="maybe")


def test_rows_without_an_id_station_or_time(spark, frame, root):
    at = datetime(2020, 1, 5)
    rows = [(at, None, 0.0, 0.0, None, "t", 1.0), (at, None, 0.0, 0.0, None, "t", 2.0), (at, "s", 0.0, 0.0, "a", "t", 2.0), (None, "s", 0.0, 0.0, "b", "t", 1.0)]
    ingest(spark, frame(rows[:1] + rows[2:], RAW), config(), "01", "1.0.0", root)
    assert ingest(spark, frame(rows[::-1], RAW), config(), "01", "1.0.0", root).agg(F.sum("n_obs")).first()[0] == 1
    assert ingest(spark, frame(rows[1:], RAW), config(), "01", "1.0.0", root).count() == 0
    assert read_listed_tiles(spark, root).count() == 3


def test_two_writers_of_one_period(spark, frame, root, monkeypatch):
    rows, first = raw_rows((1, 2)), []
    real = ingestion.write_tiles

    def meanwhile(*args, **kwargs):
        real(*args, **kwargs)
        if not first:  # another ingestion of the same rows begins and ends before this one commits
            first.append(True)
            ingest(spark, frame(rows[:12], RAW), config(), "01", "1.0.0", root)

    monkeypatch.setattr(ingestion, "write_tiles", meanwhile)
    late = ingest(spark, frame(rows, RAW), config(), "01", "1.0.0", root)
    assert late.agg(F.sum("n_obs")).first()[0] == 12
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in rows)
    assert [c.number for c in read_log(spark, root)] == [1, 2]


def test_writers_of_different_tiles_both_commit(spark, frame, root):
    log = read_log(spark, root)
    for month in (1, 2):
        run = new_run()
        write_tiles(tiled_observations(frame(raw_rows((month,)), RAW), config(), "01", "1.0.0"), root, run)
        commit_run(spark, root, run, "month", log=log)
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2)))
    with pytest.raises(CommitConflict):
        commit_run(spark, root, run, "month", log=log)
    assert read_listed_tiles(spark, root).count() == 24


def test_compaction_keeps_rows_and_entries(spark, frame, root):
    rows = raw_rows((1, 2), 20)
    for k in range(6):
        run = new_run() if k < 4 else f"s-{k}"
        write_tiles(tiled_observations(frame(rows[k::6], RAW), config(), "01", "1.0.0"), root, run)
        commit_run(spark, root, run, "month")
    columns = ["asset", "n_obs", "stations", "variables", "file_checksum", "data_size"]
    entries = read_catalogue(spark, root)
    before, n_files = sorted(map(tuple, entries.select(columns).collect())), files_of(spark, root, entries).count()
    old_reader = read_listed_tiles(spark, root)
    assert compact(spark, root, "month").count() > 0
    entries = read_catalogue(spark, root)
    files = files_of(spark, root, entries)
    assert sorted(map(tuple, entries.select(columns).collect())) == before and files.count() < n_files
    assert ids(read_listed_tiles(spark, root)) == ids(old_reader) == sorted(r[4] for r in rows)
    # A run stays only where it is the only one of its kind in a tile.
    assert files.groupBy("dataset", "time_start", "lat_start", "lon_start", F.col("run").startswith("s-")).count().where("count > 1").count() == 0
    assert ids(read_stream_tiles(spark, root)) == sorted(r[4] for k in (4, 5) for r in rows[k::6])
    sizes = files.agg(F.sum("bytes")).first()[0]
    assert entries.agg(F.sum("file_size")).first()[0] == sizes and read_parts(spark, root).agg(F.sum("n_obs")).first()[0] == len(rows)
    assert compact(spark, root, "month").count() == 0
    fold_log(spark, root)
    assert sorted(map(tuple, read_catalogue(spark, root).select(columns).collect())) == before
    assert ingest(spark, frame(rows, RAW), config(), "01", "1.0.0", root).count() == 0


def test_only_listed_files_are_opened(spark, frame, root):
    import shutil

    for months in ((1,), (2,), (3,)):
        ingest(spark, frame(raw_rows(months), RAW), config(), "01", "1.0.0", root)
    versions = frame([("sondes", "1.0.0", False)], "dataset string, version string, deprecated boolean")
    request = Request(time_coverage=("2020-02-10", "2020-03-01"), latitude_coverage=(-60.0, 0.0))
    shutil.rmtree(f"{root}/parts")  # retrieval does not look there
    got = retrieve_stored(spark, root, versions, "sondes", request, "month")
    wanted = {r.path for r in files_of(spark, root, read_catalogue(spark, root).where(request.entry_condition("sondes"))).where(request.file_condition()).collect()}
    opened = {"tiles/" + f.split("/tiles/")[1] for f in got.inputFiles()}
    assert opened == wanted and 0 < len(opened) < files_of(spark, root, read_catalogue(spark, root)).count() / 2
    assert ids(got) == ids(retrieve_rows(frame(raw_rows((1, 2, 3)), RAW), request))


def test_awkward_identity_names(spark, frame, root):
    odd = config(name="a+b c%d", sources={"x/y=z": config().sources["01"]})
    ingest(spark, frame(raw_rows((1,)), RAW), odd, "x/y=z", "1.0.0", root)
    assert ingest(spark, frame(raw_rows((1,))[:5], RAW), odd, "x/y=z", "1.0.0", root).count() == 0
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1,)))
    assert {tuple(r) for r in read_listed_tiles(spark, root).select("dataset", "dataset_source").collect()} == {("a+b c%d", "x/y=z")}


def test_overlapping_streamed_files(spark, frame, tmp_path, root):
    rows, source = raw_rows((1, 2)), str(tmp_path / "in")
    for part in (rows[:15], rows[5:20], rows[10:], rows[:3]):
        frame(part, RAW).coalesce(1).write.mode("append").parquet(source)
    stream = open_file_stream(spark, source, spark.read.parquet(source).schema, "*.parquet", files_per_batch=1)
    stream_tiles(stream, config(), "01", "1.0.0", root).awaitTermination()
    assert ids(read_stream_tiles(spark, root)) == sorted(r[4] for r in rows)
    # Each micro-batch is in the log, also one that brought nothing.
    assert len({c.run for c in read_log(spark, root)}) == 4


def test_deleted_tiles_can_be_ingested_again(spark, frame, root):
    raw = frame(raw_rows((1, 2)), RAW)
    ingest(spark, raw, config(), "01", "1.0.0", root)
    replace_catalogue(read_catalogue(spark, root).where("latitude_coverage_start >= 0"), root)
    assert read_listed_tiles(spark, root).count() < 24
    ingest(spark, raw, config(), "01", "1.0.0", root)
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in raw_rows((1, 2)))
