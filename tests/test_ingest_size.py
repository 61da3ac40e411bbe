"""What an ingestion moves: rows before they are melted, late rows by column, paths once a file."""

import os
from dataclasses import replace
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stationtide.config import AuxColumn, UnitChange
from stationtide.functions.times import ts
from stationtide.model.definitions import default_graph
from stationtide.operators.catalogue import build_catalogue, tile_parts
from stationtide.operators.dedupe import count_different
from stationtide.operators.quality import validation_report
from stationtide.operators.tiling import TILE_KEYS, assign_tiles
from stationtide.plans import ingest as plan
from stationtide.plans.ingest import IngestError, ingest, tiled_observations
from stationtide.session import shared_dir, staged, tidied
from stationtide.sources.store import has_catalogue, read_catalogue, read_listed_tiles, read_tiles, write_manifest, write_tiles
from tests.test_store import RAW, config, ids, raw_rows, root  # noqa: F401


def test_rows_are_gathered_before_they_are_melted(spark, frame):
    raw = frame(raw_rows((1, 2)), RAW).drop("observation_id").withColumns({"t": F.col("observation_value"), "p": F.col("observation_value") * 2}).drop("observed_variable", "observation_value")
    cfg = config()
    wide = replace(cfg, sources={"01": replace(cfg.sources["01"], melt=True, observation_key=("primary_station_id", "report_timestamp"))})
    gathered = tiled_observations(raw, wide, "01", "1.0.0", gather=True)
    plan = gathered._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Expand") < plan.index("RebalancePartitions")
    plain = tiled_observations(raw, wide, "01", "1.0.0")
    assert gathered.columns == plain.columns and sorted(map(str, gathered.collect())) == sorted(map(str, plain.collect()))


def test_rows_that_come_late_are_not_checkpointed(spark, frame, root, monkeypatch):
    cut, seen = plan.cut_lineage, []
    monkeypatch.setattr(plan, "cut_lineage", lambda df: (seen.extend(df.columns), cut(df))[1])
    rows = raw_rows((1,))
    for part in (rows[::2], rows):
        ingest(spark, frame(part, RAW), config(), "01", "1.0.0", root)
    assert ids(read_listed_tiles(spark, root)) == sorted(r[4] for r in rows)
    assert "observation_value" not in seen


def test_manifest_keys_of_odd_names(spark, frame, root):
    odd = "a b+c%25/x=1"
    tiled = assign_tiles(frame(raw_rows((1,)), RAW).withColumns({"dataset": F.lit("d"), "version": F.lit("1"), "dataset_source": F.lit(odd)}), 90, 180)
    write_tiles(tiled, root, "r1", {"dataset": "d", "version": "1", "dataset_source": odd})
    files = write_manifest(spark, root, "r1")
    stored = read_tiles(spark, root, ["r1"]).groupBy(*TILE_KEYS, "dataset_source").count()
    assert sorted(map(tuple, files.select(*TILE_KEYS, "dataset_source", "n_rows").collect())) == sorted(map(tuple, stored.collect()))
    assert files.where(F.col("dataset_source") != odd).count() == 0


def wide_source(frame, n=12):
    """Rows of two variables each, one of them with an uncertainty and sometimes without a value."""
    raw = frame(raw_rows((1, 2), n), RAW).drop("observation_id", "observed_variable").withColumnRenamed("observation_value", "t")
    raw = raw.withColumns({"p": F.when(F.col("t") % 3 > 0, F.col("t") * 2), "spread": F.col("t") / 7, "flag": F.when(F.col("t") % 2 > 0, 1)})
    cfg = config(time_tile_size="year")
    source = replace(cfg.sources["01"], melt=True, observation_key=("primary_station_id", "report_timestamp"), unit_changes={"t": UnitChange("degC", "K", 1.0, 273.15)},
                     uncertainty={"total_uncertainty": (AuxColumn("spread", "t", "K"),)}, quality_flag=(AuxColumn("flag", "p"),))
    return raw, replace(cfg, sources={"01": source})


def test_parts_of_rows_that_are_not_melted_yet(spark, frame, monkeypatch):
    raw, cfg = wide_source(frame)
    long = tiled_observations(raw, cfg, "01", "1.0.0")
    for by_day in (True, False):
        want, got = tile_parts(long, by_day=by_day), plan.parts_of_raw(raw, cfg, "01", "1.0.0", by_day=by_day)
        assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert "Expand" in want._jdf.queryExecution().optimizedPlan().toString() and "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_stored_rows_of_new_periods_are_not_hashed_again(spark, frame, root, monkeypatch):
    raw, cfg = wide_source(frame)
    hashed = []
    monkeypatch.setattr(plan, "tile_parts", lambda *a, **k: hashed.append(a) or tile_parts(*a, **k))
    january = F.col("report_timestamp") < ts("2020-02-01")
    # February is new in a year that is stored; the third ingestion has rows that are stored and a row that is not.
    for part, n_hashed in ((raw.where(january), 0), (raw.where(~january), 0), (wide_source(frame, 13)[0], 1)):
        ingest(spark, part, cfg, "01", "1.0.0", root)
        assert len(hashed) == n_hashed
    whole = build_catalogue(tile_parts(tiled_observations(wide_source(frame, 13)[0], cfg, "01", "1.0.0")), "year")
    columns = ["asset", "n_obs", "data_size", "file_checksum"]
    assert sorted(map(tuple, read_catalogue(spark, root).select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))


def test_files_that_lack_rows_are_not_listed(spark, frame, root, monkeypatch):
    raw, cfg = wide_source(frame)
    monkeypatch.setattr(plan, "write_tiles", lambda rows, *a, **k: write_tiles(rows.where("observed_variable = 't'"), *a, **k))
    with pytest.raises(plan.IngestError):
        ingest(spark, raw, cfg, "01", "1.0.0", root)
    assert not has_catalogue(spark, root)


def test_ids_and_units_of_rows_that_are_melted(spark, frame):
    raw, cfg = wide_source(frame)
    optimized = plan.observations_of(raw, cfg, "01")._jdf.queryExecution().optimizedPlan().toString()
    # The key is put together once for all variables of a row, and the unit rules need no join.
    assert "replace(" not in optimized[:optimized.index("Expand")] and "replace(" in optimized
    assert "Join" not in optimized


def test_saved_rows_are_checked_in_one_pass(spark, frame, tmp_path):
    raw, cfg = wide_source(frame)
    raw = raw.withColumns({"primary_station_id": F.when(F.col("t") > 1, F.col("primary_station_id")), "odd.one": F.when(F.col("t") > 2, F.col("t"))})
    codes = frame([("t", "K")], "name string, units string")
    n, path = raw.count(), str(tmp_path / "cdm")
    found = plan.make_cdm(raw, cfg, "01", default_graph(), codes, path)
    rows = spark.read.parquet(path)
    strange = [r for r in map(tuple, found.collect()) if r[0] == "unknown_column" and r[1] == "odd.one"]
    assert strange == [("unknown_column", "odd.one", rows.where("`odd.one` IS NOT NULL").count())] and rows.count() == 2 * n
    assert [tuple(r) for r in found.where("check = 'variable'").collect()] == [("variable", "p", n)]
    assert found.columns == ["check", "item", "n_rows"]
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1


def test_checks_of_no_rows_and_of_several_units(frame):
    codes = frame([("t", "K"), ("q", "m")], "name string, units string")
    kind = "observation_id string, report_id bigint, observed_variable string, units string, strange int"
    some = [("a", 1, "t", "K", None), (None, 2, "t", "C", 5), ("c", None, "t", None, None), ("d", 4, "x", "K", None), ("e", 5, "x", "m", None), ("f", 6, None, "m", None), ("g", 7, "q", "m", 7)]
    report = lambda rows: sorted(map(str, map(tuple, validation_report(frame(rows, kind), default_graph(), codes).collect())))
    typed = {"observations_table.report_id": 6, "header_table.report_id": 6, "observations_table.observed_variable": 6, "observations_table.units": 6}
    keys = [("primary_key", k, 1) for k in ("observations_table.observation_id", "header_table.report_id", "uncertainty_table.observation_id")]
    units = [("variable", None, 1), ("variable", "x", 1), ("variable", "x", 1), ("units", "t in C", 1), ("units", "t", 1)]
    assert report(some) == sorted(map(str, [*[("type", c, n) for c, n in typed.items()], *keys, *units, ("unknown_column", "strange", 2)]))
    assert report([]) == sorted(map(str, [*[("type", c, 0) for c in typed], ("unknown_column", "strange", 0)]))


def test_saved_ids_have_no_dictionary(spark, frame, tmp_path):
    raw, cfg = wide_source(frame)
    # Where ids do repeat, a dictionary would be kept; the option is seen by that.
    raw = raw.crossJoin(spark.range(20)).drop("id").coalesce(1)
    plan.make_cdm(raw, cfg, "01", default_graph(), frame([("t", "K")], "name string, units string"), str(tmp_path / "cdm"))
    for file in (tmp_path / "cdm").glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        coded = {c.path_in_schema: any("DICTIONARY" in e for e in c.encodings) for c in map(group.column, range(group.num_columns))}
        assert not coded["observation_id"] and coded["units"]


def test_an_ingestion_leaves_no_scratch(spark, frame, root, monkeypatch):
    name, during = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    monkeypatch.setattr(plan, "staged", lambda df, label: (during.append((label, spark.conf.get(name))), staged(df, label))[1])
    raw, cfg = wide_source(frame)
    folder = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before, conf = set(os.listdir(folder)), spark.conf.get(name, None)
    late = raw.withColumn("t", F.when(F.col("t") == 1, F.lit(50.0)).otherwise(F.col("t")))
    for part in (raw.where("t < 5"), raw, raw):
        ingest(spark, part, cfg, "01", "1.0.0", root)
    with pytest.raises(IngestError):
        ingest(spark, late, cfg, "01", "1.0.0", root)
    assert {label for label, _ in during} == {"raw", "came", "differ", "known", "judged"} and {c for _, c in during} == {"true"}
    assert not [f for f in set(os.listdir(folder)) - before if f.rsplit("-", 1)[0] in {label for label, _ in during}]
    assert spark.conf.get(name, None) == conf


def test_shuffles_and_staged_rows_go_with_their_work(spark, frame):
    with tidied(spark, spark):
        rows = staged(spark.range(100).repartition(3, "id"), "some")
        path = rows.inputFiles()[0]
        assert rows.count() == 100
    assert not os.path.exists(os.path.dirname(path.removeprefix("file://")))
    outside = staged(spark.range(5), "some")
    assert outside.count() == 5


def test_raw_rows_are_put_together_once(spark, frame, root, monkeypatch):
    raw, cfg = wide_source(frame)
    stations = frame([(f"s{i}", i) for i in range(4)], "primary_station_id string, extra int")
    seen = []
    counted = plan.raw_batches
    monkeypatch.setattr(plan, "raw_batches", lambda df, *a: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), counted(df, *a))[1])
    joined = raw.join(stations, "primary_station_id").drop("extra")
    for part in (joined.where("t < 5"), joined):
        ingest(spark, part, cfg, "01", "1.0.0", root)
    assert len(seen) == 2 and not any("Join" in p for p in seen)


def test_parts_that_are_not_stored_are_not_judged(spark, frame, root, monkeypatch):
    """Two days of a station are stored; then a row comes for a stored day, and a third day comes: only the stored day is compared by id."""
    judged = []
    monkeypatch.setattr(plan, "staged", lambda df, label: (out := staged(df, label), label == "judged" and judged.append(out.count()))[0])
    rows = lambda *of: frame([(time, "s1", 10.0, 10.0, float(v)) for time, v in of], "report_timestamp timestamp_ntz, primary_station_id string, latitude double, longitude double, t double").withColumns(
        {"p": F.col("t") * 2, "spread": F.col("t") / 7, "flag": F.lit(1)})
    _, cfg = wide_source(frame)
    first = [(datetime(2020, 1, 1, 1), 1), (datetime(2020, 1, 2, 1), 2)]
    again = [*first, (datetime(2020, 1, 1, 5), 3), *((datetime(2020, 1, 3, h), 10 + h) for h in range(9))]
    ingest(spark, rows(*first), cfg, "01", "1.0.0", root)
    ingest(spark, rows(*again), cfg, "01", "1.0.0", root)
    assert judged == [2]
    stored = read_listed_tiles(spark, root)
    assert stored.count() == 2 * len(again) == stored.select("observation_id").distinct().count()
    want = build_catalogue(tile_parts(tiled_observations(rows(*again), cfg, "01", "1.0.0")), "year").select("asset", "n_obs", "file_checksum")
    assert sorted(map(tuple, read_catalogue(spark, root).select("asset", "n_obs", "file_checksum").collect())) == sorted(map(tuple, want.collect()))


def test_an_id_that_moves_to_a_part_without_rows_is_known(spark, frame, root):
    """Its old part differs, as the row is missing there, and holds the id; the new part holds nothing yet."""
    rows = raw_rows((1,))
    two = [(rows[1][0], "s1", 10.0, 10.0, i, "t", float(k)) for k, i in enumerate("ab")]
    moved = [two[0], (two[1][0], "s9", *two[1][2:]), (two[1][0], "s8", 10.0, 10.0, "c", "t", 5.0)]
    ingest(spark, frame(two, RAW), config(), "01", "1.0.0", root)
    with pytest.raises(IngestError, match="1 stored observations came with other values, observation b"):
        ingest(spark, frame(moved, RAW), config(), "01", "1.0.0", root)
    ingest(spark, frame(moved, RAW), config(), "01", "1.0.0", root, on_change="replace")
    stored = sorted((r.observation_id, r.primary_station_id) for r in read_listed_tiles(spark, root).collect())
    assert stored == [("a", "s1"), ("b", "s9"), ("c", "s8")]


def test_different_values_are_counted_exactly(frame):
    rows = [("x", "a"), ("x", "a"), ("x", "b"), ("x", None), ("y", "a"), (None, "c"), (None, "c"), ("z", None)] + [("x", f"v{i}") for i in range(50)]
    got = count_different(frame(rows, "g string, v string"), ["g"], "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("x", 52), ("y", 1), (None, 1)], key=str)
    assert count_different(frame([], "g string, v string"), ["g"], "v").count() == 0
