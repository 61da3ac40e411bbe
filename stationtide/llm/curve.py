"""Shards as runs of a Hilbert curve through quantised metadata.

Each dimension is quantised to a few bits, the Hilbert index of the cell orders the rows, and equal runs of that order
are the shards, so that neighbouring rows, and with them the value ranges of a file, are close in every dimension at
once. Only built-in functions are used: the curve is tabulated for all cells, whose number is fixed by the bits; rows
are range-partitioned by (index, text checksum, id), and a row's rank is its place in the partition plus the rows of
the partitions before. No key is ever gathered in one task: a large cell is cut by checksum and id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationtide.llm.common import written

#: Bits of each dimension, and the dimensions: three give at most 2**15 cells, a table of that many rows.
BITS = 5
DIMENSIONS = 3


def hilbert_table(spark: SparkSession, bits: int = BITS, dimensions: int = DIMENSIONS) -> DataFrame:
    """``cell`` (the coordinates, the first in the highest bits) and ``curve`` (its place on the Hilbert curve) of every cell.

    The coordinates are turned from the highest bit down: where a coordinate has the bit, the lower bits of the first are
    inverted, elsewhere they are exchanged with the first's. A Gray code of the outcome, read bit by bit across the
    dimensions, is the index.
    """
    low = (1 << bits) - 1
    x = F.array(*(F.shiftright("cell", bits * (dimensions - 1 - d)).bitwiseAND(F.lit(low)).cast("int") for d in range(dimensions)))
    moves = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(d).alias("d")) for b in range(bits - 1, 0, -1) for d in range(dimensions)))

    def turn(state: Column, move: Column) -> Column:
        first, own = state[0], F.get(state, move["d"])
        below = move["q"] - 1
        has = own.bitwiseAND(move["q"]) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(below)
        return F.transform(state, lambda v, d: F.when(has & (d == 0), v.bitwiseXOR(below)).when(~has & ((d == 0) | (d == move["d"])), v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(moves, x, turn) if bits > 1 else x
    gray = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda d: F.aggregate(F.slice("turned", 1, d + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))
    highs = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1)))
    last = F.aggregate(highs, F.lit(0), lambda a, q: F.when(F.element_at("gray", -1).bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a)) if bits > 1 else F.lit(0)
    index = F.lit(0)
    for b in range(bits - 1, -1, -1):
        for d in range(dimensions):
            index = index * 2 + F.shiftright(F.col("code")[d], b).bitwiseAND(F.lit(1))
    return (spark.range(1 << bits * dimensions).select(F.col("id").cast("int").alias("cell")).withColumn("turned", turned).withColumn("gray", gray)
            .withColumn("last", last).withColumn("code", F.transform("gray", lambda v: v.bitwiseXOR(F.col("last")))).select("cell", index.alias("curve")))


def category(value: Column, bits: int = BITS) -> Column:
    """Quantised text value: the top bits of its checksum, 0 for null."""
    return F.coalesce(F.shiftright(F.crc32(value.cast("string").cast("binary")), 32 - bits), F.lit(0)).cast("int")


def magnitude(value: Column, bits: int = BITS) -> Column:
    """Quantised non-negative number: half octaves from 16 on, null and smaller ones 0."""
    return F.coalesce(F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.floor(2 * F.log2(value.cast("double") + 1) - 8))), F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, shards: int = 24, with_rows: bool = False) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of each row of ``docs`` (doc_id, text, lang, source).

    The law is ``rows``: shard counts differ by one at most, and ``slot`` counts the rows of a shard from 0 in curve order.
    The dimensions are language, source and size. ``size`` is the text's UTF-8 bytes plus 8, 8 for null and empty texts,
    ``text_crc32`` the checksum of these bytes. Null ids, languages and sources are values like any other; repeated rows
    have a slot each; equal texts of equal metadata stand side by side; an empty table gives an empty result. ``lang``
    and ``source`` may be missing. ``with_rows`` adds ``row``, a struct of all columns of ``docs``, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    meta = [category(F.col(c)) if c in docs.columns else F.lit(0) for c in ("lang", "source")]
    size = (F.octet_length(text) + 8).cast("long")
    cell = F.shiftleft(meta[0], 2 * BITS).bitwiseOR(F.shiftleft(meta[1], BITS)).bitwiseOR(magnitude(size - 8))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), cell.alias("cell"),
                       *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if with_rows else []))
    placed = rows.join(F.broadcast(hilbert_table(spark)), "cell").drop("cell")
    order = ["curve", "text_crc32", "doc_id"]
    # The id has the partition in its upper bits and the place in the sorted partition in its lower 33.
    sorted_rows = written(placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "curve")
    part = F.shiftright("at", 33)
    counts = [(r.part, r.n) for r in sorted_rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()]
    before, total = [], 0
    for number, n in counts:
        before.append((number, total))
        total += n
    offsets = spark.createDataFrame(before, "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    shard = F.expr(f"CAST(rank * {shards} DIV {max(1, total)} AS INT)")
    start = F.expr(f"(CAST(shard AS LONG) * {total} + {shards - 1}) DIV {shards}")
    return (sorted_rows.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", rank).withColumn("shard", shard)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                    *(["row"] if with_rows else [])))


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Write the rows of ``docs`` as Parquet below ``path``, a folder for each shard, in curve order."""
    placed = shard_documents(docs, shards, with_rows=True)
    out = placed.select(F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), "row.*")
    out.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
