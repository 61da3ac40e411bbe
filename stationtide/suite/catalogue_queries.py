"""Catalogue filters and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationtide.operators.catalogue import (
    CatalogueFilter, absent_datasets, absent_versions, assets_present, capabilities, consistency, copy_entries,
    delete_entries, empty_versions, filter_catalogue, in_catalogue_order, insert_entries, last_versions,
    migrate_to_versions, missing_entries, of_months, page_of, remove_assets, set_deprecated, tile_status,
    with_deprecation, without_empty_versions,
)
from stationtide.suite.registry import query
from stationtide.suite.views import catalogue, events_catalogue, stored_catalogue, versions_of

_EVERY = {"deprecated": "all"}


@query("""SELECT asset, n_obs FROM cat WHERE dataset = 'orders' AND dataset_source = 'O' AND version = '10.0.0'""")
def q_cat_by_dataset(spark, folder):
    wanted = CatalogueFilter(dataset="orders", dataset_source="O", versions=("10.0.0",), **_EVERY)
    return filter_catalogue(catalogue(spark, folder), None, wanted).select("asset", "n_obs")


@query("""SELECT asset FROM cat WHERE list_has_any(stations, ['0-20000-0-7', '0-20999-0-10', '0-20000-0-99'])
          AND list_has_any(variables, ['1-URGENT', '5-LOW'])""")
def q_cat_array_overlap(spark, folder):
    wanted = CatalogueFilter(stations=("0-20000-0-7", "0-20999-0-10", "0-20000-0-99"), variables=("1-URGENT", "5-LOW"), **_EVERY)
    return filter_catalogue(catalogue(spark, folder), None, wanted).select("asset")


@query("""SELECT asset FROM cat WHERE t0 < TIMESTAMP '1997-03-15' AND TIMESTAMP '1996-11-10' < t1 AND lat0 < 50 AND -20 < lat1 AND lat0 < lat1
          AND lon0 < 100 AND 0 < lon1 AND lon0 < lon1""")
def q_cat_range_overlap(spark, folder):
    wanted = CatalogueFilter(time=("1996-11-10 00:00:00", "1997-03-15 00:00:00"), latitudes=(-20.0, 50.0), longitudes=(0.0, 100.0), **_EVERY)
    return filter_catalogue(catalogue(spark, folder), None, wanted).select("asset")


@query("""SELECT asset FROM cat WHERE year(t0) IN (1996, 1999) AND month(t0) IN (2, 7, 12)""")
def q_cat_year_month(spark, folder):
    return of_months(catalogue(spark, folder), (1996, 1999), (2, 7, 12)).select("asset")


@query("""SELECT asset FROM cat WHERE t0 <= TIMESTAMP '1998-05-20' AND t1 >= TIMESTAMP '1998-05-20' AND lat0 <= 45 AND lat1 >= 45 AND lon0 <= -30 AND lon1 >= -30""")
def q_cat_point(spark, folder):
    wanted = CatalogueFilter(time=("1998-05-20 00:00:00",), latitudes=(45.0,), longitudes=(-30.0,), **_EVERY)
    return filter_catalogue(catalogue(spark, folder), None, wanted).select("asset")


@query("""SELECT asset, t0 AS time_coverage_start FROM cat ORDER BY t0, lat0, lon1, asset LIMIT 50 OFFSET 100""")
def q_cat_page(spark, folder):
    return page_of(in_catalogue_order(catalogue(spark, folder)), 3).select("asset", "time_coverage_start")


@query("""SELECT dataset, version, count(*) AS n_tiles FROM cat WHERE version = '10.0.0' GROUP BY ALL""")
def q_version_last(spark, folder):
    entries = catalogue(spark, folder).select("dataset", "version")
    last = last_versions(versions_of(entries))
    return entries.join(last, ["dataset", "version"]).groupBy("dataset", "version").agg(F.count(F.lit(1)).alias("n_tiles"))


@query("""SELECT dataset_source, deprecated, count(*) AS n_tiles FROM cat JOIN versions USING (dataset, version) GROUP BY ALL""")
def q_deprecated_filter(spark, folder):
    entries = catalogue(spark, folder).select("dataset", "version", "dataset_source")
    versions = versions_of(entries)
    parts = [with_deprecation(entries, versions, flag).withColumn("deprecated", F.lit(flag)) for flag in (True, False)]
    return parts[0].unionByName(parts[1]).groupBy("dataset_source", "deprecated").agg(F.count(F.lit(1)).alias("n_tiles"))


@query("""SELECT asset FROM cat n WHERE NOT EXISTS (SELECT 1 FROM cat e WHERE year(e.t0) < 1998 AND e.dataset_source = n.dataset_source
            AND e.version = n.version AND e.t0 = n.t0 AND e.t1 = n.t1 AND e.lat0 >= n.lat0 AND e.lat1 <= n.lat1 AND e.lon0 >= n.lon0 AND e.lon1 <= n.lon1)""")
def q_entry_anti(spark, folder):
    entries = stored_catalogue(spark, folder)
    return missing_entries(entries, entries.where(F.year("time_coverage_start") < 1998)).select("asset")


@query("""SELECT asset, CASE WHEN year(t0) >= 2000 THEN 'new' WHEN year(t0) = 1996 THEN 'exists_different' ELSE 'exists_identical' END AS status FROM cat""")
def q_tile_status(spark, folder):
    entries = stored_catalogue(spark, folder)
    year = F.year("time_coverage_start")
    stored = entries.where(year < 2000).withColumn(
        "file_checksum", F.when(year == 1996, F.concat("file_checksum", F.lit("x"))).otherwise(F.col("file_checksum")))
    return tile_status(entries, stored).select("asset", "status")


@query("""SELECT 'archive' AS dataset, version, concat('archive/', string_split(asset, '/')[2]) AS asset FROM cat
          WHERE version = '2.0.0' AND year(t0) >= 1997""")
def q_cat_copy(spark, folder):
    entries = stored_catalogue(spark, folder)
    # The target already holds the first two years.
    held = entries.where((F.year("time_coverage_start") < 1997) & (F.col("version") == "2.0.0")).withColumn("dataset", F.lit("archive"))
    both = insert_entries(entries, held)
    added, _ = copy_entries(both, versions_of(both), "orders", "2.0.0", "archive")
    return added.select("dataset", "version", "asset")


@query("""SELECT kind, count(*) AS n_tiles, CAST(sum(n_obs) AS BIGINT) AS n_obs FROM (SELECT *, CASE WHEN dataset_source = 'F' AND version = '2.0.0'
            AND t0 < TIMESTAMP '1996-01-01' AND TIMESTAMP '1995-03-01' < t1 THEN 'deleted' ELSE 'kept' END AS kind FROM cat) GROUP BY 1""")
def q_cat_delete(spark, folder):
    wanted = CatalogueFilter(dataset="orders", dataset_source="F", time=("1995-03-01 00:00:00", "1996-01-01 00:00:00"), versions=("2.0.0",), **_EVERY)
    kept, deleted = delete_entries(catalogue(spark, folder), wanted)
    both = kept.withColumn("kind", F.lit("kept")).unionByName(deleted.withColumn("kind", F.lit("deleted")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n_tiles"), F.sum("n_obs").alias("n_obs"))


@query("""SELECT '1.0.0' AS version, concat('orders/', replace(string_split(asset, '/')[2], 'orders', 'orders_1.0.0')) AS asset FROM cat""")
def q_cat_migrate(spark, folder):
    return migrate_to_versions(catalogue(spark, folder).drop("version")).select("version", "asset")


@query("""SELECT dataset, version, version = '2.0.0' OR version = '11.0.0' AS deprecated FROM versions""")
def q_version_toggle(spark, folder):
    return set_deprecated(versions_of(catalogue(spark, folder)), "orders", "2.0.0", True)


@query("""SELECT dataset, version, CASE WHEN version = '11.0.0' THEN 'emptied' ELSE 'kept' END AS state FROM versions""")
def q_empty_versions(spark, folder):
    entries = catalogue(spark, folder)
    versions = versions_of(entries)
    remaining, _ = delete_entries(entries, CatalogueFilter(dataset="orders", versions=("11.0.0",), **_EVERY))
    gone = empty_versions(versions, remaining).withColumn("state", F.lit("emptied"))
    kept = without_empty_versions(versions, remaining).withColumn("state", F.lit("kept"))
    return gone.unionByName(kept).select("dataset", "version", "state")


@query("""SELECT asset FROM cat WHERE month(t0) = 5""")
def q_cat_exists(spark, folder):
    entries = catalogue(spark, folder)
    asked = entries.where(F.month("time_coverage_start") == 5).select("asset").unionByName(
        entries.select(F.concat(F.lit("absent/"), F.col("asset")).alias("asset")))
    return assets_present(asked, entries)


@query("""SELECT dataset, version, true AS deprecated, n_tiles, false AS known_dataset FROM (
            SELECT concat('new_', dataset_source) AS dataset, version, count(*) AS n_tiles FROM cat WHERE dataset_source <> 'F' GROUP BY ALL)""")
def q_create_if_absent(spark, folder):
    entries = catalogue(spark, folder)
    wanted = entries.withColumn("dataset", F.when(F.col("dataset_source") == "F", F.col("dataset")).otherwise(F.concat(F.lit("new_"), F.col("dataset_source"))))
    counted = wanted.groupBy("dataset", "version").agg(F.count(F.lit(1)).alias("n_tiles"))
    created = absent_versions(versions_of(entries), counted)
    unknown = absent_datasets(entries.select("dataset").distinct(), wanted).withColumn("known_dataset", F.lit(False))
    return created.join(unknown, "dataset").select("dataset", "version", "deprecated", "n_tiles", "known_dataset")


@query("""SELECT asset, n_obs FROM cat WHERE year(t0) <> 1997 UNION ALL SELECT concat('copy/', asset), n_obs FROM cat WHERE year(t0) = 1998""")
def q_cat_insert_remove(spark, folder):
    entries = catalogue(spark, folder).select("asset", "n_obs", "time_coverage_start")
    added = entries.where(F.year("time_coverage_start") == 1998).withColumn("asset", F.concat(F.lit("copy/"), F.col("asset")))
    removed = entries.where(F.year("time_coverage_start") == 1997)
    return remove_assets(insert_entries(entries, added), removed).select("asset", "n_obs")


@query("""SELECT dataset, dataset_source FROM cat GROUP BY ALL UNION ALL SELECT 'events', 'events'""")
def q_capabilities(spark, folder):
    both = insert_entries(catalogue(spark, folder), events_catalogue(spark, folder))
    return capabilities(both).orderBy("dataset", "dataset_source")


@query("""SELECT asset, 'missing_in_storage' AS problem FROM cat WHERE month(t0) = 3 UNION ALL
          SELECT concat(asset, '.tmp'), 'missing_in_catalogue' FROM cat WHERE month(t0) = 8""")
def q_consistency(spark, folder):
    entries = catalogue(spark, folder).select("asset", "time_coverage_start")
    month = F.month("time_coverage_start")
    stored = entries.where(month != 3).select("asset").unionByName(
        entries.where(month == 8).select(F.concat("asset", F.lit(".tmp")).alias("asset")))
    return consistency(entries, stored)
