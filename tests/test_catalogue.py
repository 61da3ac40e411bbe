from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationtide.functions.intervals import overlaps, tile_may_hold
from stationtide.functions.names import follows_dataset_convention, is_version, readable_size, version_key
from stationtide.operators.catalogue import (
    CatalogueFilter, absent_versions, consistency, copy_entries, delete_entries, empty_versions, filter_catalogue,
    last_versions, migrate_to_versions, missing_entries, set_deprecated, tile_status,
)

SCHEMA = (
    "dataset string, version string, dataset_source string, time_coverage_start timestamp_ntz, time_coverage_end timestamp_ntz, "
    "latitude_coverage_start double, latitude_coverage_end double, longitude_coverage_start double, longitude_coverage_end double, "
    "variables array<string>, stations array<string>, asset string, file_checksum string, data_size bigint"
)


def entry(month=2, lat=40.0, lon=95.0, size=10.0, version="1.0.0", checksum="c", dataset="sondes", year=1969):
    start = datetime(year, month, 1)
    end = datetime(year + month // 12, month % 12 + 1, 1)
    asset = f"{dataset}/{dataset}_{version}_OzoneSonde_{year}{month:02d}_{lat}_{lon}.nc"
    return (dataset, version, "OzoneSonde", start, end, lat, lat + size, lon, lon + size,
            ["air_pressure", "geopotential_height"], ["7"], asset, checksum, 1)


@pytest.fixture
def catalogue(frame):
    return frame([entry(1, 45.0, 100.0)], SCHEMA)


@pytest.fixture
def versions(frame):
    return frame([("sondes", "1.0.0", False)], "dataset string, version string, deprecated boolean")


def test_filters_select_as_expected(catalogue, versions):
    base = dict(dataset="sondes", dataset_source="OzoneSonde", latitudes=(45.0,), longitudes=(100.0,),
                variables=("air_pressure", "air_temperature"), stations=("7",), versions=("1.0.0",))
    point, span = ("1969-01-15 00:00:00",), ("1968-12-31 00:00:00", "1969-03-03 00:00:00")

    def count(**changes):
        return filter_catalogue(catalogue, versions, CatalogueFilter(**{**base, **changes})).count()

    assert filter_catalogue(catalogue, versions, CatalogueFilter()).count() == 1
    assert [count(time=point), count(time=span), count(time=span, deprecated=True), count(time=span, deprecated="all"),
            count(time=span, deprecated="all", versions=("2.0.0",))] == [1, 1, 0, 1, 0]


def test_ranges_are_half_open(spark):
    one = spark.range(1)
    check = lambda c: one.select(c.alias("v")).first().v
    lit = F.lit
    assert not check(overlaps(lit(0), lit(5), 5, 9)) and check(overlaps(lit(0), lit(5), 4, 9))
    assert not check(overlaps(lit(5), lit(5), 0, 9))
    # The zero-width tile on the pole belongs to requests that end there.
    assert check(tile_may_hold(lit(90), lit(90), 80.0, 90.0, 90.0)) and not check(tile_may_hold(lit(90), lit(90), 0.0, 80.0, 90.0))


def test_versions_order_by_number(frame):
    versions = frame([("d", "2.0.0", False), ("d", "10.0.0", False), ("d", "10.0.0-rc1", False), ("d", "11.0.0", True)],
                     "dataset string, version string, deprecated boolean")
    assert last_versions(versions).first().version == "10.0.0"
    ordered = [r.version for r in versions.orderBy(version_key(F.col("version"))).collect()]
    assert ordered == ["2.0.0", "10.0.0-rc1", "10.0.0", "11.0.0"]
    assert last_versions(versions.where("deprecated")).count() == 0


def test_name_rules(frame):
    df = frame([("good_name", "1.0.0", 1536.0), ("Bad Name", "1.0", 10.0)], "n string, v string, s double")
    assert [tuple(r) for r in df.select(follows_dataset_convention(F.col("n")), is_version(F.col("v")), readable_size(F.col("s"))).collect()] == [
        (True, True, "1.5KiB"), (False, False, "10.0B")]


def test_entry_exists_inside_a_larger_box(frame):
    stored = frame([entry(2, 40.0, 95.0, 10.0)], SCHEMA)
    new = frame([entry(2, -90.0, -70.0, 180.0), entry(2, 40.0, 95.0, 10.0), entry(2, 45.0, 95.0, 10.0), entry(3, 40.0, 95.0, 10.0),
                 entry(2, 40.0, 95.0, 10.0, "2.0.0")], SCHEMA)
    # The first box is larger and holds the stored tile.
    missing = missing_entries(new, stored).select("time_coverage_start", "latitude_coverage_start", "version").collect()
    assert sorted(tuple(r) for r in missing) == [
        (datetime(1969, 2, 1), 40.0, "2.0.0"), (datetime(1969, 2, 1), 45.0, "1.0.0"), (datetime(1969, 3, 1), 40.0, "1.0.0")]


def test_tile_status(frame):
    stored = frame([entry(1), entry(2)], SCHEMA)
    new = frame([entry(1), entry(2, checksum="other"), entry(3)], SCHEMA)
    assert {r.time_coverage_start.month: r.status for r in tile_status(new, stored).collect()} == {
        1: "exists_identical", 2: "exists_different", 3: "new"}


def test_copy_is_idempotent(frame, versions):
    catalogue = frame([entry(1), entry(2)], SCHEMA)
    added, created = copy_entries(catalogue, versions, "sondes", "1.0.0", "copied")
    assert {r.asset.split("/")[0] for r in added.collect()} == {"copied"} and added.count() == 2
    assert [tuple(r) for r in created.collect()] == [("copied", "1.0.0", True)]
    both = catalogue.unionByName(added)
    again, none = copy_entries(both, versions.unionByName(created), "sondes", "1.0.0", "copied")
    assert again.count() == 0 and none.count() == 0


def test_delete_drops_emptied_versions(frame, versions):
    catalogue = frame([entry(1), entry(2)], SCHEMA)
    wanted = CatalogueFilter(dataset="sondes", time=("1969-02-02 00:00:00", "1969-02-03 00:00:00"), deprecated="all")
    remaining, deleted = delete_entries(catalogue, wanted)
    assert (remaining.count(), deleted.count(), empty_versions(versions, remaining).count()) == (1, 1, 0)
    remaining, _ = delete_entries(catalogue, CatalogueFilter(dataset="sondes", deprecated="all"))
    assert empty_versions(versions, remaining).count() == 1


def test_version_flags(versions, frame):
    assert set_deprecated(versions, "sondes", "1.0.0", True).first().deprecated
    with pytest.raises(LookupError):
        set_deprecated(versions, "sondes", "9.0.0", True)
    wanted = frame([("sondes", "1.0.0"), ("sondes", "2.0.0")], "dataset string, version string")
    assert [tuple(r) for r in absent_versions(versions, wanted).collect()] == [("sondes", "2.0.0", True)]


def test_migration_names_the_version(frame):
    old = frame([("sondes", "bucket/sondes_OzoneSonde_196901_0.0_0.0.nc")], "dataset string, asset string")
    assert migrate_to_versions(old).first().asset == "bucket/sondes_1.0.0_OzoneSonde_196901_0.0_0.0.nc"


def test_consistency_reports_both_sides(frame):
    a, b = frame([("x",), ("y",)], "asset string"), frame([("y",), ("z",)], "asset string")
    assert {tuple(r) for r in consistency(a, b).collect()} == {("x", "missing_in_storage"), ("z", "missing_in_catalogue")}
