"""Exact duplicates by two passes over a Bloom filter, with built-in functions only.

The first pass sets HASHES cells for each text's digest and keeps the cells that were hit at least twice: a digest that
occurs twice has hit all of its cells twice. The second pass looks each digest up. Where a cell was hit once only, the
text is alone and its row passes straight through; the others, repeated or not, are grouped exactly by digest, and
only these shuffle. The filter has CELLS cells for each row, so that about one lone row in seventy is grouped in vain
at any size.

The cells are counted by a partial aggregate, so that a text which is a third of all rows is one row of a task. The filter
is a table of blocks of bits: it is broadcast where the number of blocks allows, and beyond that rows and blocks meet in
an equi-join, with which digests (not texts) are shuffled too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationtide.llm.common import written
from stationtide.session import broadcast_if_small

#: Cells of the filter for each row, and cells that a digest sets.
CELLS = 16
HASHES = 2
#: A block has WORDS words of 64 cells.
WORDS = 64
#: Blocks of 512 bytes that may be broadcast: 128 MB at most, which serves 64 million rows.
BROADCAST_BLOCKS = 1 << 18


def normal_text(text: Column) -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normal text, 32 bytes; long texts, short ones and empty ones alike."""
    return F.unhex(F.sha2(normal_text(text), 256))


def cells_of(code: Column, cells: int) -> list[Column]:
    """The cells of a digest, ``cells`` being a power of two."""
    return [F.xxhash64(code, F.lit(k)).bitwiseAND(F.lit(cells - 1)) for k in range(HASHES)]


def repeated_cells(codes: DataFrame, cells: int) -> DataFrame:
    """``block``, ``bits`` (array of WORDS longs): the cells that the digests in ``codes`` (code) hit at least twice."""
    hits = codes.select(F.explode(F.array(*cells_of(F.col("code"), cells))).alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = hits.groupBy((F.shiftright("cell", 6)).alias("word")).agg(F.bit_or(bit).alias("bits"))
    # At most WORDS different words make a block.
    blocks = words.groupBy(F.expr(f"word DIV {WORDS}").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("word") % WORDS).cast("int").alias("k"), "bits"))).alias("by"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.coalesce(F.try_element_at(F.col("by"), k), F.lit(0).cast("long")))
    return blocks.select("block", dense.alias("bits"))


def with_maybe(rows: DataFrame, blocks: DataFrame, cells: int) -> DataFrame:
    """``rows`` with ``_maybe``: whether all cells of ``_code`` were hit at least twice, so that the digest may be repeated."""
    per = 64 * WORDS
    blocks = broadcast_if_small(blocks, BROADCAST_BLOCKS)
    out, maybe = rows, F.lit(True)
    for k, cell in enumerate(cells_of(F.col("_code"), cells)):
        out = out.withColumn(f"_cell{k}", cell).join(
            blocks.select(F.col("block").alias(f"_block{k}"), F.col("bits").alias(f"_bits{k}")), F.expr(f"_cell{k} DIV {per} = _block{k}"), "left")
        word = F.get(F.col(f"_bits{k}"), F.expr(f"CAST((_cell{k} % {per}) DIV 64 AS INT)"))
        maybe = maybe & F.coalesce(F.getbit(word, F.expr(f"CAST(_cell{k} & 63 AS INT)")) == 1, F.lit(False))
    out = out.withColumn("_maybe", maybe)
    return out.drop(*(f"_{name}{k}" for k in range(HASHES) for name in ("cell", "block", "bits")))


class Repeats:
    """Digests of the rows of ``docs`` (doc_id, text), the filter over them, and the groups of equal texts."""

    def __init__(self, docs: DataFrame):
        codes = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("_code"))
                        .withColumn("_at", F.monotonically_increasing_id()), "digests")
        n = codes.count()
        self.cells = 1 << max(12, (CELLS * n - 1).bit_length())
        self.blocks = written(repeated_cells(codes.select(F.col("_code").alias("code")), self.cells), "repeated")
        self.rows = written(with_maybe(codes, self.blocks, self.cells), "digests")
        some = self.rows.filter("_maybe").groupBy("_code").agg(
            F.count("*").alias("_n"), F.min("doc_id").alias("_keep"), F.coalesce(F.min_by("_at", "doc_id"), F.min("_at")).alias("_first"))
        self.groups = written(some.filter("_n > 1"), "groups")


def mark_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for each row of ``docs`` (doc_id, text), dropped ones too.

    Texts are equal if they are so with each run of white space as one space; null counts as empty. Of equal texts
    the row with the smallest doc_id is kept, rows without an id only where no other has one (``keep_id`` is null then);
    of rows that repeat that id too, one is kept. An empty table gives an empty result; other columns are not read.
    """
    found = Repeats(docs)
    sha = F.lower(F.hex("_code")).alias("text_sha256")
    alone = found.rows.filter("NOT _maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    met = found.rows.filter("_maybe").join(broadcast_if_small(found.groups), "_code", "left")
    several = F.col("_n").isNotNull()
    return alone.union(met.select(
        "doc_id", F.when(several, F.col("_keep")).otherwise(F.col("doc_id")).alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.when(several, F.col("_at") == F.col("_first")).otherwise(True).alias("kept"), sha))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``mark_repeats`` keeps, all columns unchanged; rows whose text is alone are not shuffled.

    Rows that repeat both the text and the smallest id differ in other columns at most; one of them stays.
    """
    found = Repeats(docs)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    own = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("_id"), digest(F.col("text")).alias("_code"))
    marked = with_maybe(own, found.blocks, found.cells)
    met = marked.filter("_maybe").join(broadcast_if_small(found.groups), "_code", "left")
    firsts = met.filter(F.col("_n").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))).dropDuplicates(["_code", "_id"])
    return marked.filter("NOT _maybe").select("_row").union(firsts.select("_row")).select("_row.*")


def oracle_sql() -> str:
    """The same rows by a plain grouping."""
    return r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)
"""
