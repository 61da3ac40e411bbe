"""Multi-table station archives: one table per archive table, all stations together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.functions.times import from_seconds
from stationtide.model.definitions import TableGraph
from stationtide.operators.archive import (
    apply_displacement, batch_stations, in_seconds, read_columns, record_intervals, reports_in_batch, rows_of_intervals, without_repeated,
)
from stationtide.operators.dedupe import first_per_key
from stationtide.operators.joins import align_by_position, assert_same_length, join_tables
from stationtide.operators.relational import denormalise
from stationtide.session import cut_lineage

# Tables without a key of their own and the name they have for an observation's id, and the fields of a station index entry in file order.
KEYLESS = {"era5fb_table": "obs_id", "advanced_homogenisation": "observation_id", "advanced_uncertainty": "observation_id"}
INDEX_FIELDS = ("record_start", "record_end", "latitude", "longitude", "country", "file_path")


def read_station_index(spark: SparkSession, path: str) -> DataFrame:
    """JSON object ``station id -> [start, end, lat, lon, country, path]`` as one row per station.

    The object is parsed as a map and exploded, so the stations are rows from
    the start and no schema with a column per station is inferred.
    """
    text = spark.read.option("wholetext", True).text(path)
    parsed = text.select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("primary_station_id", "v"))
    item = lambda i: F.element_at("v", i + 1)
    return parsed.select(
        "primary_station_id", item(0).cast("bigint").alias("record_start"), item(1).cast("bigint").alias("record_end"),
        item(2).cast("double").alias("latitude"), item(3).cast("double").alias("longitude"),
        item(4).alias("country"), item(5).alias("file_path"),
    )


def read_station_index_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same index as JSON lines (one station per line): splittable, for large indexes."""
    schema = "primary_station_id string, record_start bigint, record_end bigint, latitude double, longitude double, country string, file_path string"
    return spark.read.schema(schema).json(path)


def decode_times(df: DataFrame, columns=("record_timestamp", "report_timestamp", "date_time")) -> DataFrame:
    """Seconds since the origin -> timestamps, for the columns that still hold numbers."""
    numeric = [c for c in columns if c in df.columns and dict(df.dtypes)[c] in ("int", "bigint", "double", "float")]
    return df.withColumns({c: from_seconds(F.col(c).cast("bigint")) for c in numeric}) if numeric else df


def cleaned(name: str, frame: DataFrame) -> DataFrame:
    return without_repeated(read_columns(frame), name)


def attach_keyless(tables: dict[str, DataFrame], position: list[str]) -> dict[str, DataFrame]:
    """Columns of the keyless tables on the observations at the same source positions, in one join for each table.

    Only the observations that are left are aligned, and no table is joined with itself.
    """
    out = dict(tables)
    observations = cleaned("observations_table", out["observations_table"])
    for name in KEYLESS:
        if name in out:
            extra = with_uncertainty(cleaned(name, out.pop(name))) if name == "advanced_uncertainty" else cleaned(name, out.pop(name))
            observations = join_tables(extra, observations, [(p, p) for p in position], name, "observations_table")
            if name == "advanced_uncertainty" and "units" in observations.columns:
                observations = observations.withColumn("uncertainty_units1", F.col("units"))
    return out | {"observations_table": observations}


def with_uncertainty(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({"desroziers_30": "uncertainty_value1"}).withColumn("uncertainty_type1", F.lit(1))


def prepare_tables(tables: dict[str, DataFrame], position: list[str]) -> dict[str, DataFrame]:
    """Table-specific cleaning before the tables are joined.

    Keyless tables that are still apart get the observation id of the row at the same source position.
    """
    out = {name: cleaned(name, frame) for name, frame in tables.items()}
    observations = out["observations_table"]
    if {"latd", "lond", "timed"} <= set(observations.columns):
        observations = apply_displacement(observations)
    if "station_configuration" in out:
        stations = out["station_configuration"]
        out["station_configuration"] = first_per_key(
            stations, ["primary_id", "record_number"], [c for c in stations.columns if c not in ("primary_id", "record_number")]
        )
    for name in KEYLESS:
        if name not in out:
            continue
        ids = observations.select(*position, F.col("observation_id").alias(KEYLESS[name]), *(
            [F.col("units").alias("uncertainty_units1")] if name == "advanced_uncertainty" and "units" in observations.columns else []))
        aligned = align_by_position(ids, out[name], position).drop(*position)
        out[name] = with_uncertainty(aligned) if name == "advanced_uncertainty" else aligned
    out["observations_table"] = observations.drop(*position)
    return out


def read_archive(tables: dict[str, DataFrame], graph: TableGraph, start, end, box, position: list[str] = (),
                 stations: DataFrame | None = None, check: bool = True, sorted_by_date: dict[str, str] | None = None,
                 record_index: DataFrame | None = None) -> DataFrame:
    """Flat rows of one period and box, all stations in one plan.

    Stations are pruned by the index, reports by time and box; both filters reach the header scan. Observations are cut
    to the selected reports before anything is aligned or joined with them. ``check`` compares the lengths of tables that
    are aligned by position, which reads no column.

    Tables that are sorted by date get a time mask of their own before anything else: ``sorted_by_date`` names their time
    columns, and ``record_index`` gives the rows of the period in the tables that are sorted by variable and date.
    """
    work = dict(tables)
    header = reports_in_batch(work["header_table"], start, end, box)
    if stations is not None:
        wanted = batch_stations(stations, start, end, box).select("primary_station_id")
        header = header.join(wanted, "primary_station_id", "left_semi")
    work["header_table"] = header
    observations = work["observations_table"]
    for name in KEYLESS if check else ():
        if name in work:
            assert_same_length(observations, work[name])
    for name, column in (sorted_by_date or {}).items():
        if name in work and name != "header_table":
            work[name] = work[name].where(in_seconds(column, start, end))
    if record_index is not None:
        intervals = cut_lineage(record_intervals(record_index, start, end, position[0]))
        for name in ("observations_table", *KEYLESS):
            if name in work:
                work[name] = rows_of_intervals(work[name], intervals, position)
    observations = work["observations_table"]
    link = next((k for k in graph["observations_table"].foreign_keys if k.parent == "header_table"), None)
    if link is not None and link.field in observations.columns:
        reports = header.select(F.col(link.parent_field).alias(link.field))
        work["observations_table"] = observations.join(reports, link.field, "left_semi")
    return denormalise(prepare_tables(attach_keyless(work, list(position)), list(position)), graph)
