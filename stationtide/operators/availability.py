"""Which station reported which variable on which day.

Exploded rows are the stored truth. Their compact form is a bitmap of days for each (entry, variable, station), whose row
grows with the calendar alone; positions, the full table, sizes and the JSON of an entry are views that are derived from it
row by row. The nested form of an entry (stations, days, positions of each variable in one row) is for exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from stationtide.functions.names import zero_padded
from stationtide.functions.times import day_of


def availability(df: DataFrame, keys=(), time_column: str = "report_timestamp") -> DataFrame:
    """Distinct (keys, station, day, variable)."""
    return df.select(
        *keys, F.col("primary_station_id").cast("string").alias("station"), day_of(F.col(time_column)).alias("day"),
        F.col("observed_variable").alias("variable"),
    ).distinct()


def wide_availability(rows: DataFrame, variables: list[str], keys=()) -> DataFrame:
    """One boolean column per declared variable for each (station, day)."""
    group = rows.groupBy(*keys, "station", "day")
    return group.agg(*[F.coalesce(F.bool_or(F.col("variable") == v), F.lit(False)).alias(v) for v in variables])


def narrow_availability(wide: DataFrame, variables: list[str], keys=()) -> DataFrame:
    """Inverse of :func:`wide_availability`: keep the true cells as rows."""
    return wide.unpivot([*keys, "station", "day"], variables, "variable", "found").where("found").drop("found")


def from_parts(parts: DataFrame, keys=("dataset_source", "version")) -> DataFrame:
    """Availability rows of stored parts at day grain, named for the constraint functions."""
    return parts.select(
        F.col(keys[0]).alias("source"), F.col(keys[1]).alias("version"), "station", "day", "variable").distinct()


def day_bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, variable, station): ``first_day`` of the entry, and ``words`` (word, bits), 64 days each.

    Rows are aggregated to words before anything is collected, so no row grows with more than the days of its entry.
    """
    spans = rows.groupBy(*keys).agg(F.min("day").alias("first_day"))
    offset = F.datediff("day", "first_day")
    placed = rows.join(spans, keys).withColumns({"_word": F.floor(offset / 64).cast("int"), "_bit": (offset % 64).cast("int")})
    words = placed.groupBy(*keys, "first_day", "variable", "station", "_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))
    return words.groupBy(*keys, "first_day", "variable", "station").agg(F.array_sort(F.collect_list(F.struct(F.col("_word").alias("word"), "bits"))).alias("words"))


def days_of(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse of :func:`day_bitmaps`: (keys, station, day, variable)."""
    words = bitmaps.select(*keys, "first_day", "variable", "station", F.explode("words").alias("w"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(F.col("w.bits"), b) == 1)
    return words.select(*keys, "station", "variable", "first_day", F.col("w.word").alias("_word"), F.explode(bits).alias("_bit")).select(
        *keys, "station", F.date_add("first_day", F.col("_word") * 64 + F.col("_bit")).alias("day"), "variable")


def entry_axes(bitmaps: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, station, station_index, n_days) and (keys, day, day_index): the places on the axes of each entry.

    Days come from bitmaps that are joined over all stations; both lists are those that the catalogue has anyway.
    """
    words = bitmaps.select(*keys, "first_day", F.explode("words").alias("w")).groupBy(*keys, "first_day", F.col("w.word").alias("_word")).agg(F.bit_or("w.bits").alias("bits"))
    whole = words.groupBy(*keys, "first_day").agg(F.array_sort(F.collect_list(F.struct(F.col("_word").alias("word"), "bits"))).alias("words"))
    listed = days_of(whole.withColumns({"variable": F.lit(None), "station": F.lit(None)}), keys).select(*keys, "day")
    days = listed.withColumn("day_index", F.row_number().over(Window.partitionBy(*keys).orderBy("day")) - 1)
    n_days = words.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias("n_days"))
    stations = bitmaps.select(*keys, "station").distinct()
    stations = stations.withColumn("station_index", F.row_number().over(Window.partitionBy(*keys).orderBy("station")) - 1)
    return stations.join(n_days, keys), days


def positions_of(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variable, position): places in station x day order, a row for each."""
    stations, days = entry_axes(bitmaps, keys)
    placed = days_of(bitmaps, keys).join(stations, [*keys, "station"]).join(days, [*keys, "day"])
    return placed.select(*keys, "variable", (F.col("station_index") * F.col("n_days") + F.col("day_index")).alias("position"))


def bitmap_size(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`constraint_size` of each entry, from the bits that are set for any variable."""
    words = bitmaps.select(*keys, "station", "variable", F.explode("words").alias("w"))
    any_variable = words.groupBy(*keys, "station", F.col("w.word").alias("_word")).agg(F.bit_or("w.bits").alias("bits"))
    positions = any_variable.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias("_n"))
    variables = bitmaps.groupBy(*keys).agg(F.count_distinct("variable").alias("_v"))
    return positions.join(variables, keys).select(*keys, (F.col("_n") * F.col("_v")).alias("n_observations"))


def bitmap_table(bitmaps: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """:func:`constraint_table` of each entry: every station on every day of the entry, with one boolean per variable."""
    stations, days = entry_axes(bitmaps, keys)
    flags = days_of(bitmaps, keys).groupBy(*keys, "station", "day").agg(*[F.bool_or(F.col("variable") == v).alias(v) for v in variables])
    grid = stations.select(*keys, "station").join(days.select(*keys, "day"), keys)
    joined = grid.join(flags, [*keys, "station", "day"], "left")
    return joined.select(*keys, "station", "day", *[F.coalesce(F.col(v), F.lit(False)).alias(v) for v in variables])


def json_fragments(bitmaps: DataFrame, keys: list[str], step: int = 10_000) -> DataFrame:
    """(keys, part, at, text): pieces of the JSON object of each entry, in the order (part, at).

    Put one after the other they are what :func:`constraints_to_json` gives in one row. A piece holds a station, a day or
    some of the ``step`` positions that follow each other; no piece grows with the entry.
    """
    stations, days = entry_axes(bitmaps, keys)
    comma = lambda index: F.when(index > 0, F.lit(",")).otherwise(F.lit(""))
    piece = lambda df, part, at, text: df.select(*keys, F.lit(part).alias("part"), at.cast("string").alias("at"), text.alias("text"))
    padded = lambda n: F.format_string("%020d", n.cast("bigint"))
    bare = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    entries = stations.select(*keys).distinct()
    cells = positions_of(bitmaps, keys).withColumn("_chunk", F.floor(F.col("position") / step))
    chunks = cells.groupBy(*keys, "variable", "_chunk").agg(F.array_sort(F.collect_set("position")).alias("p"))
    firsts = chunks.groupBy(*keys, "variable").agg(F.min("_chunk").alias("_first"))
    least = firsts.groupBy(*keys).agg(F.min("variable").alias("_least"))
    body = chunks.join(firsts, [*keys, "variable"]).join(least, keys)
    opening = F.concat(F.when(F.col("variable") == F.col("_least"), F.lit("")).otherwise(F.lit("],")), bare("variable"), F.lit(":["))
    text = F.concat(F.when(F.col("_chunk") == F.col("_first"), opening).otherwise(F.lit(",")), F.concat_ws(",", F.transform("p", lambda x: x.cast("string"))))
    pieces = [
        piece(entries, 0, F.lit(""), F.lit('{"stations":[')),
        piece(stations, 1, padded(F.col("station_index")), F.concat(comma(F.col("station_index")), bare("station"))),
        piece(entries, 2, F.lit(""), F.lit('],"days":[')),
        piece(days, 3, padded(F.col("day_index")), F.concat(comma(F.col("day_index")), F.lit('"'), F.col("day").cast("string"), F.lit('"'))),
        piece(entries, 4, F.lit(""), F.lit('],"variable_constraints":{')),
        piece(body, 5, F.concat(F.col("variable"), F.lit("\u0000"), padded(F.col("_chunk"))), text),
        piece(entries, 6, F.lit(""), F.lit("]}}")),
    ]
    return reduce(DataFrame.unionByName, pieces)


def write_entry_json(bitmaps: DataFrame, keys: list[str], path: str) -> None:
    """Write the JSON object of each entry below ``path`` as text, entry by entry: the files in their order are the objects one after
    the other, a piece in each line. Range partitions keep the order, so that an entry of any size is written by many tasks."""
    pieces = json_fragments(bitmaps, keys)
    order = [*keys, "part", "at"]
    pieces.repartitionByRange(*order).sortWithinPartitions(*order).select("text").write.mode("overwrite").text(path)


def encode_constraints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The nested form, one row per entry: sorted stations and days, and per variable the positions in station x day order.

    Positions come from joins with the numbered axes, so the rows of an entry
    are never gathered before they are reduced to positions.
    """
    axes = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_set("station")).alias("stations"), F.array_sort(F.collect_set("day")).alias("days")
    )
    station_axis, day_axis = _axes(axes, keys)
    placed = rows.join(station_axis, [*keys, "station"]).join(day_axis, [*keys, "day"])
    position = F.col("station_index") * F.col("n_days") + F.col("day_index")
    per_variable = placed.groupBy(*keys, "variable").agg(F.array_sort(F.collect_set(position)).alias("positions"))
    encoded = per_variable.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("variable", "positions")))).alias("variable_constraints")
    )
    return axes.join(encoded, keys)


def _axes(encoded: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Numbered stations (with the number of days) and numbered days of each entry."""
    stations = encoded.select(
        *keys, F.size("days").alias("n_days"), F.posexplode("stations").alias("station_index", "station"))
    days = encoded.select(*keys, F.posexplode("days").alias("day_index", "day"))
    return stations, days


def _positions(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variable, position). Only positions are exploded: no row carries the axes along."""
    flat = encoded.select(*keys, F.explode("variable_constraints").alias("variable", "positions"))
    return flat.select(*keys, "variable", F.explode("positions").alias("position"))


def decode_constraints(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse of :func:`encode_constraints`: positions joined with the numbered axes."""
    stations, days = _axes(encoded, keys)
    n_days = encoded.select(*keys, F.size("days").alias("_n"))
    placed = _positions(encoded, keys).join(n_days, keys).select(
        *keys, "variable", F.floor(F.col("position") / F.col("_n")).cast("int").alias("station_index"),
        (F.col("position") % F.col("_n")).cast("int").alias("day_index"))
    found = placed.join(stations.drop("n_days"), [*keys, "station_index"]).join(days, [*keys, "day_index"])
    return found.select(*keys, "station", "day", "variable")


def constraint_table(encoded: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Full station x day table of each entry with one boolean per variable.

    The false cells are the point of this view; use the exploded rows elsewhere.
    """
    grid = encoded.select(
        *keys, F.size("days").alias("n_days"), "days", F.posexplode("stations").alias("station_index", "station")
    ).select(*keys, "n_days", "station_index", "station", F.posexplode("days").alias("day_index", "day"))
    grid = grid.withColumn("position", F.col("station_index") * F.col("n_days") + F.col("day_index"))
    flags = _positions(encoded, keys).groupBy(*keys, "position").agg(
        *[F.bool_or(F.col("variable") == v).alias(v) for v in variables])
    joined = grid.join(flags, [*keys, "position"], "left")
    return joined.select(*keys, "station", "day", *[F.coalesce(F.col(v), F.lit(False)).alias(v) for v in variables])


def constraint_size(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """Number of distinct positions times the number of variables."""
    positions = F.size(F.array_distinct(F.flatten(F.map_values("variable_constraints"))))
    return encoded.select(*keys, (positions * F.size("variable_constraints")).alias("n_observations"))


def merge_constraints(rows: DataFrame, variables: list[str]) -> DataFrame:
    """Per (day, source, version): is there any station with the variable; absent cells are false."""
    return rows.groupBy(F.col("day").alias("time"), "source", "version").agg(
        *[F.coalesce(F.bool_or(F.col("variable") == v), F.lit(False)).alias(v) for v in variables]
    )


def flat_constraints(rows: DataFrame) -> DataFrame:
    """Distinct (source, version, variable, year, month, day) with padded text values."""
    distinct = rows.select("source", "version", "variable", "day").distinct()
    return distinct.select(
        F.col("source").alias("dataset_source"), "version", F.col("variable").alias("variables"),
        F.year("day").cast("string").alias("year"), zero_padded(F.month("day"), 2).alias("month"),
        zero_padded(F.dayofmonth("day"), 2).alias("day"),
    )


# The stored form of an encoded entry.
CONSTRAINT_SCHEMA = "stations array<string>, days array<string>, variable_constraints map<string, array<bigint>>"


def constraints_to_json(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, json): each encoded entry as one JSON object of stations, days and positions."""
    days = F.transform("days", lambda d: d.cast("string")).alias("days")
    return encoded.select(*keys, F.to_json(F.struct("stations", days, "variable_constraints")).alias("json"))


def constraints_from_json(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse of :func:`constraints_to_json`; a text that is no such object is an error."""
    parsed = texts.select(*keys, F.from_json("json", CONSTRAINT_SCHEMA, {"mode": "FAILFAST"}).alias("c"))
    return parsed.select(*keys, "c.stations", F.transform("c.days", lambda d: d.cast("date")).alias("days"), "c.variable_constraints")
