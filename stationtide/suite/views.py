"""Observation-like views of the driver tables, once as DataFrames and once as SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationtide.config import AuxColumn, DatasetConfig, Description, SourceConfig, SpaceColumns, UnitChange
from stationtide.model.literals import literal_table
from stationtide.operators.catalogue import build_catalogue, catalogue_of, tile_parts
from stationtide.operators.tiling import assign_tiles
from stationtide.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def station_id(key: Column) -> Column:
    prefix = F.when(key % 10 == 0, "0-20999-0-").otherwise("0-20000-0-")
    return F.concat(prefix, key.cast("string"))


def latitude_of(key: Column) -> Column:
    return ((key * 37) % 181 - 90).cast("double")


def longitude_of(key: Column) -> Column:
    return ((key * 73) % 361 - 180).cast("double")


def _one(key: Column) -> Column:
    """1, but not a constant to the optimizer, which would turn a key join on it into a product."""
    return F.when(key.isNotNull(), 1)


def station(spark, folder) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("station_key"), station_id(key).alias("primary_station_id"), _one(key).alias("record_number"),
        F.col("c_name").alias("station_name"), F.col("c_nationkey").alias("country"),
        latitude_of(key).alias("latitude"), longitude_of(key).alias("longitude"),
    )


def obs(spark, folder) -> DataFrame:
    user = F.col("user_id")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("observation_id"), (F.col("event_id") - F.col("event_id") % 10).alias("report_id"),
        station_id(user).alias("primary_station_id"), latitude_of(user).alias("latitude"),
        longitude_of(user).alias("longitude"), F.col("ts").alias("report_timestamp"),
        F.col("event_type").alias("observed_variable"), F.col("value").alias("observation_value"),
    )


def hdr(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("report_id"), F.col("o_custkey").alias("station_key"),
        _one(F.col("o_orderkey")).alias("station_record_number"), F.col("o_orderdate").alias("report_timestamp"),
        F.col("o_orderstatus").alias("dataset_source"), F.col("o_orderpriority").alias("observed_variable"),
        F.col("o_totalprice").alias("observation_value"),
    )


def wide(spark, folder) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1)
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("report_id"), F.col("l_linenumber").alias("level"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        flag.alias("price_quality_flag"), F.col("l_tax").alias("price_total_uncertainty"),
        F.col("l_shipdate").alias("record_timestamp"),
    )


def placed_reports(spark, folder) -> DataFrame:
    """Report headers with the position of their station."""
    where = station(spark, folder).select("station_key", "primary_station_id", "latitude", "longitude")
    return hdr(spark, folder).join(where, "station_key")


def varcode(spark) -> DataFrame:
    text = pa.string()
    return literal_table(spark, [("code", pa.int32()), ("name", text), ("units", text)], [
        (1, "click", "1"), (2, "view", "1"), (3, "purchase", "K"), (4, "signup", "1"), (138, "error", "%")])


def unit_codes(spark) -> DataFrame:
    return literal_table(spark, [("code", pa.int32()), ("abbreviation", pa.string())], [
        (1, "m"), (5, "K"), (32, "Pa"), (300, "%")])


def catalogue(spark, folder) -> DataFrame:
    """Catalogue of the placed reports: month x 45 x 45 degree tiles, one version per source."""
    version = F.when(F.col("dataset_source") == "F", "2.0.0").when(F.col("dataset_source") == "O", "10.0.0").otherwise("11.0.0")
    rows = placed_reports(spark, folder).select(
        "report_id", "primary_station_id", "latitude", "longitude", "report_timestamp", "observed_variable",
        "observation_value", "dataset_source",
    )
    tiled = assign_tiles(rows, 45, 45).withColumns({
        "dataset": F.when(F.col("dataset_source").isNotNull(), "orders"), "version": version})
    return build_catalogue(tile_parts(tiled), "month")


def stored_catalogue(spark, folder) -> DataFrame:
    """The same catalogue as a table on shared storage, for queries that read it several times."""
    path = scratch_path(spark, "catalogue")
    catalogue(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


def versions_of(entries: DataFrame) -> DataFrame:
    return entries.select("dataset", "version").distinct().withColumn("deprecated", F.col("version") == "11.0.0")


def events_catalogue(spark, folder, version: str = "1.0.0") -> DataFrame:
    rows = obs(spark, folder).withColumn("dataset_source", F.lit("events"))
    return catalogue_of(assign_tiles(rows, 45, 45), "month", "events", version)


VARIABLES = ("click", "view", "purchase", "signup", "error")

EVENTS = DatasetConfig(
    name="events",
    reader="flat_parquet",
    lat_tile_size=45,
    lon_tile_size=45,
    space=SpaceColumns("longitude", "latitude"),
    disabled_fields=("quality_flag",),
    sources={"events": SourceConfig(
        main_variables=VARIABLES,
        descriptions={
            "report_timestamp": Description("datetime64[ns]", "time of the report"),
            "primary_station_id": Description("object", "station"),
            "click": Description("float64", "click count", "cm"),
            "view": Description("float64", "views", "1"),
            "purchase": Description("float64", "purchases", "K"),
            "signup": Description("float64", "signups", "1"),
            "error": Description("float64", "errors", "%"),
            "quality_flag": Description("uint8", "flag"),
        },
        unit_changes={
            "click": UnitChange("m", "cm", 100.0, 0.0),
            "purchase": UnitChange("degC", "K", 1.0, 273.15),
        },
    )},
)

MEASURES = ("quantity", "price", "discount", "tax")

REPORTS = DatasetConfig(
    name="reports",
    reader="header_and_data",
    lat_tile_size=90,
    lon_tile_size=180,
    time_tile_size="year",
    space=SpaceColumns("longitude", "latitude"),
    sources={"ship_and_land": SourceConfig(
        main_variables=MEASURES,
        header_table="orders",
        data_table="lineitem",
        join_header="o_orderkey",
        join_data="l_orderkey",
        header_columns=("report_timestamp", "primary_station_id", "latitude", "longitude"),
        rename={
            "obs_date": "report_timestamp", "stn": "primary_station_id", "lat": "latitude", "lon": "longitude",
            "l_linenumber": "z_coordinate", "l_partkey": "source_id", "l_suppkey": "sensor_id",
            "l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax",
            "flag": "price_quality_flag", "spread": "price_total_uncertainty",
        },
        add={"z_coordinate_type": 0},
        descriptions={
            "report_timestamp": Description("datetime64[ns]", "time"),
            "primary_station_id": Description("object", "station"),
            "latitude": Description("float64", "latitude"),
            "longitude": Description("float64", "longitude"),
            "z_coordinate": Description("float64", "level"),
            "source_id": Description("object", "part"),
            "sensor_id": Description("object", "supplier"),
            "quantity": Description("float64", "quantity", "1"),
            "price": Description("float64", "price", "cent"),
            "discount": Description("float64", "discount", "1"),
            "tax": Description("float64", "tax", "1"),
        },
        unit_changes={"price": UnitChange("euro", "cent", 100.0, 0.0)},
        melt=True,
        observation_key=("report_id", "z_coordinate", "source_id", "sensor_id"),
        quality_flag=(AuxColumn("price_quality_flag", "price"),),
        uncertainty={"total_uncertainty": (AuxColumn("price_total_uncertainty", "price", "cent"),)},
        columns_to_drop=("l_returnflag", "l_linestatus", "l_shipdate"),
    )},
)


def raw_report_tables(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Raw header and data tables of :data:`REPORTS`."""
    header = placed_reports(spark, folder).select(
        F.col("report_id").alias("o_orderkey"), F.col("report_timestamp").alias("obs_date"),
        F.col("primary_station_id").alias("stn"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
    )
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1)
    return header, table(spark, folder, "lineitem").withColumns({"flag": flag, "spread": F.col("l_tax")})


VIEW_SQL = {
    "station": """SELECT c_custkey AS station_key,
        CASE WHEN c_custkey % 10 = 0 THEN concat('0-20999-0-', c_custkey) ELSE concat('0-20000-0-', c_custkey) END AS primary_station_id,
        1 AS record_number, c_name AS station_name, c_nationkey AS country,
        CAST((c_custkey * 37) % 181 - 90 AS DOUBLE) AS latitude, CAST((c_custkey * 73) % 361 - 180 AS DOUBLE) AS longitude
        FROM customer""",
    "obs": """SELECT event_id AS observation_id, event_id - event_id % 10 AS report_id,
        CASE WHEN user_id % 10 = 0 THEN concat('0-20999-0-', user_id) ELSE concat('0-20000-0-', user_id) END AS primary_station_id,
        CAST((user_id * 37) % 181 - 90 AS DOUBLE) AS latitude, CAST((user_id * 73) % 361 - 180 AS DOUBLE) AS longitude,
        ts AS report_timestamp, event_type AS observed_variable, value AS observation_value FROM events""",
    "hdr": """SELECT o_orderkey AS report_id, o_custkey AS station_key, 1 AS station_record_number,
        o_orderdate AS report_timestamp, o_orderstatus AS dataset_source, o_orderpriority AS observed_variable,
        o_totalprice AS observation_value FROM orders""",
    "wide": """SELECT l_orderkey AS report_id, l_linenumber AS level, l_quantity AS quantity, l_extendedprice AS price,
        nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax,
        CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE NULL END AS price_quality_flag,
        l_tax AS price_total_uncertainty, l_shipdate AS record_timestamp FROM lineitem""",
    "varcode": """SELECT * FROM (VALUES (1,'click','1'),(2,'view','1'),(3,'purchase','K'),(4,'signup','1'),(138,'error','%')) AS t(code, name, units)""",
    "placed": """SELECT h.*, s.primary_station_id, s.latitude, s.longitude FROM hdr h JOIN station s ON h.station_key = s.station_key""",
    "placed_tiles": """SELECT p.*, CAST(date_trunc('month', p.report_timestamp) AS TIMESTAMP) AS month_start,
        CAST(floor((latitude + 90) / 45) * 45 - 90 AS INT) AS lat_start, CAST(floor((longitude + 180) / 45) * 45 - 180 AS INT) AS lon_start
        FROM placed p""",
    "cat": """SELECT 'orders' AS dataset, CASE dataset_source WHEN 'F' THEN '2.0.0' WHEN 'O' THEN '10.0.0' ELSE '11.0.0' END AS version,
        dataset_source, month_start AS t0, CAST(month_start + INTERVAL 1 MONTH AS TIMESTAMP) AS t1,
        CAST(lat_start AS DOUBLE) AS lat0, CAST(least(lat_start + 45, 90) AS DOUBLE) AS lat1,
        CAST(lon_start AS DOUBLE) AS lon0, CAST(least(lon_start + 45, 180) AS DOUBLE) AS lon1,
        list_sort(list(DISTINCT observed_variable)) AS variables, list_sort(list(DISTINCT primary_station_id)) AS stations,
        count(*) AS n_obs,
        concat('orders/orders_', CASE dataset_source WHEN 'F' THEN '2.0.0' WHEN 'O' THEN '10.0.0' ELSE '11.0.0' END, '_', dataset_source, '_',
               strftime(month_start, '%Y%m'), '_', lat_start, '.0_', lon_start, '.0.parquet') AS asset
        FROM placed_tiles GROUP BY dataset_source, month_start, lat_start, lon_start""",
    "versions": """SELECT DISTINCT dataset, version, version = '11.0.0' AS deprecated FROM cat""",
}
