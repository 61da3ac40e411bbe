"""Near-duplicates by SimHash, joined through a binary trie of fingerprints.

With at most two differing bits, two of the 64-bit fingerprints agree in one of three disjoint blocks of 21 bits. For
each block the fingerprints are bit-permuted so that the block comes first; a trie over them then splits into subtries
by that prefix, which Spark deals out, and only pairs below the same subtrie are left. In a task the subtries are
ranges of a sorted array: node pairs are walked together bit by bit, the bits in which they part are added up, and a
pair is dropped once it exceeds the budget. A subtrie with too many leaves for one task is cut again by the same
argument over its free bits, so that no bucket grows with the corpus and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationtide.llm import jaccard
from stationtide.llm.common import ids_and_texts, written
from stationtide.llm.components import connected_components, merge_labels
from stationtide.llm.jaccard import shingle_hashes
from stationtide.session import broadcast_if_small

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Free bits left, and block width, of each cut; after the last at most 2**20 different leaves can share a bucket.
CUTS = ((64, 21), (43, 14), (29, 9))
#: Leaves of a bucket that one task takes; larger ones are cut again.
BUCKET_LEAVES = 100_000
FRONTIER = 200_000


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """Fingerprint of each text as an unsigned 64-bit integer: the bits set in over half of its shingle hashes."""
    hashes = [shingle_hashes(t, SHINGLE_WORDS) for t in texts]
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, counts.sum())
        bits = np.unpackbits(flat.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=1_000_000):
                yield pa.RecordBatch.from_arrays([ids, pa.array(fingerprints(texts).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def trie_links(leaves: DataFrame) -> DataFrame:
    """``u``, ``v``: enough links among the different values of ``fp`` to connect all that differ in MAX_BITS bits or fewer."""
    cut = leaves.select("fp", F.col("fp").alias("perm"), F.lit("").alias("path"))
    found = None
    for level, (free, width) in enumerate(CUTS):
        cut = cut.select("fp", F.explode(_cuts(free, width)).alias("c")).select("fp", "c.perm", "c.path")
        sizes = cut.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        last = level == len(CUTS) - 1
        crowded = written(sizes.filter(F.col("n") > BUCKET_LEAVES), "crowded") if not last else None
        ready = cut.join(sizes if last else sizes.filter(F.col("n") <= BUCKET_LEAVES), "path", "left_semi")
        links = ready.repartition("path").sortWithinPartitions("path", "perm").mapInArrow(_walk(free - width), "u long, v long")
        found = links if found is None else found.union(links)
        if last or crowded.isEmpty():
            return found
        cut = written(cut.join(crowded, "path", "left_semi"), "cut")
    return found


def _cuts(free: int, width: int) -> Column:
    """For each of three blocks of the free low bits: the value with that block moved to their top, and the bucket."""
    perm, low = F.col("perm"), (1 << free) - 1 if free < 64 else -1
    out = []
    for block in range(3):
        shift = block * width
        if shift:
            own = perm.bitwiseAND(F.lit(low))
            turned = F.shiftleft(own, shift).bitwiseOR(F.shiftrightunsigned(own, free - shift)).bitwiseAND(F.lit(low))
            value = perm.bitwiseAND(F.lit(~low)).bitwiseOR(turned)
        else:
            value = perm
        prefix = F.hex(F.shiftrightunsigned(value, free - width))
        out.append(F.struct(value.alias("perm"), F.concat(F.col("path"), F.lit(f"{block}:"), prefix, F.lit("/")).alias("path")))
    return F.array(*out)


def _walk(free: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, perm, fp in _whole_buckets(batches):
            i, j = _walk_subtries(paths, perm, free)
            yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], ["u", "v"])

    return run


def _whole_buckets(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[tuple]:
    """Sorted rows in runs that end at a bucket's end: (start of each bucket, perm, fp)."""
    kept: list[pa.RecordBatch] = []

    def arrays(table: pa.Table) -> tuple:
        codes = table["path"].combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        return starts, table["perm"].to_numpy().view(np.uint64), table["fp"].to_numpy()

    for batch in batches:
        if batch.num_rows:
            kept.append(batch.select(["path", "perm", "fp"]))
        if sum(b.num_rows for b in kept) >= rows:
            table = pa.Table.from_batches(kept)
            starts, _, _ = arrays(table)
            if starts[-1]:
                yield arrays(table.slice(0, starts[-1]))
            kept = table.slice(starts[-1]).combine_chunks().to_batches()
    if kept:
        yield arrays(pa.Table.from_batches(kept))


def _walk_subtries(starts: np.ndarray, perm: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (i, j) between the leaves that each subtrie connects; ``perm`` ascends below each start."""
    n = len(perm)
    parent = np.arange(n)
    ends = np.append(starts[1:], n)
    stack = [(free - 1, np.stack([starts, ends, starts, ends, np.zeros(len(starts), np.int64)]))]
    while stack:
        bit, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(bit, pairs[:, half:]), (bit, pairs[:, :half])]
            continue
        single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
        i, j = pairs[0, single], pairs[2, single]
        close = np.bitwise_count(perm[i] ^ perm[j]) <= MAX_BITS
        merge_labels(parent, i[close], j[close])
        pairs = pairs[:, ~single]
        if bit < 0 or not pairs.shape[1]:
            continue
        ones = np.concatenate(([0], np.cumsum((perm >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)))
        a0, a1, b0, b1, off = pairs
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        other = a0 != b0
        below = np.concatenate([
            np.stack([a0, am, b0, bm, off]), np.stack([am, a1, bm, b1, off]), np.stack([a0, am, bm, b1, off + 1]),
            np.stack([am, a1, b0, bm, off + 1])[:, other],
        ], axis=1)
        full = (below[1] > below[0]) & (below[3] > below[2]) & (below[4] <= MAX_BITS)
        stack.append((bit - 1, below[:, full]))
    moved = np.flatnonzero(parent != np.arange(n))
    return moved, parent[moved]


def _groups(leaves: DataFrame, links: DataFrame) -> DataFrame:
    """``fp``, ``first`` (smallest id of the fingerprint's rows), ``component_id`` and ``lowest`` (smallest fingerprint of the
    component over ``links``) of each fingerprint in ``leaves`` (fp, first)."""
    members = connected_components(links).withColumnRenamed("id", "fp")
    leaves = leaves.select("fp", "first")
    linked = members.join(leaves, "fp")
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"), F.min("fp").alias("lowest"))
    named = linked.join(least, "component").select("fp", "component_id", "lowest")
    return leaves.join(named, "fp", "left").select(
        "fp", "first", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("lowest", "fp").alias("lowest"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` for each row of ``docs`` (doc_id, text).

    One output row for each input row, repeated rows included. Null and empty texts have fingerprint zero and link like
    any other. ``component_id`` is the smallest doc_id reachable over links; a row without doc_id takes part and keeps
    its null, and a component without any id has a null one. Equal fingerprints are one leaf of the trie however many
    rows share them. An empty table gives an empty result; other columns are not read.
    """
    marks = written(fingerprint_documents(docs), "marks")
    leaves = written(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "leaves")
    groups = _groups(leaves, trie_links(leaves)).select("fp", "component_id")
    return marks.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Rows of two numbers that may be broadcast when whole documents would be shuffled otherwise: some 200 MB of hash table.
LISTED_ROWS = 2_000_000


def _links_of_marks(leaves: DataFrame) -> DataFrame:
    """``u``, ``v``: enough links to connect all identities in ``leaves`` (fp, mark) whose fingerprints (``mark``) differ in
    MAX_BITS bits or fewer. The smallest identity of a fingerprint stands for it in the trie."""
    marks = written(leaves.groupBy("mark").agg(F.min("fp").alias("least")), "marks")
    equal = leaves.select("fp", "mark").join(marks, "mark").filter("fp <> least").select(F.col("fp").alias("u"), F.col("least").alias("v"))
    near = trie_links(marks.select(F.col("mark").alias("fp")))
    for end in ("u", "v"):
        near = near.join(marks.select(F.col("mark").alias(end), F.col("least").alias(f"_{end}")), end)
    return equal.union(near.select("_u", "_v"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest doc_id, all columns unchanged. Texts link as in
    ``near_duplicates``, by fingerprints that differ in MAX_BITS bits or fewer; also where their sets of five-word shingles have a
    Jaccard similarity of 0.8 or more, and equal texts anyway.

    A row's identity, told as its fingerprint below, is here that of its words. Where rows repeat that id with the same fingerprint one of them stays; of different ones, and in components without
    any id, the one with the smallest fingerprint. Rows are told by id and fingerprint: the list of those that go is
    broadcast within LISTED_ROWS, so that documents which stay are not shuffled.
    """
    described = written(jaccard.describe(docs, fingerprints), "described")
    leaves = written(described.groupBy("fp").agg(F.min("doc_id").alias("first"), *(F.first(c).alias(c) for c in ("n", "keys", "sketch", "mark"))), "leaves")
    groups = _groups(leaves, jaccard.links(docs, leaves).union(_links_of_marks(leaves)))
    chosen = groups.filter(F.col("first").eqNullSafe(F.col("component_id"))).groupBy("lowest", "component_id").agg(F.min("fp").alias("c"))
    chosen = chosen.select(F.col("component_id").alias("least"), "c")
    rows = described.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    stays = rows.join(chosen, (F.col("fp") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("least")), "left").withColumn("_stays", F.col("c").isNotNull())
    listed = written(stays.filter("NOT _stays OR n > 1").select(F.col("fp").alias("_fp_of"), F.col("doc_id").alias("_id_of"), "_stays"), "listed")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    marked = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("_id"), jaccard.identity(F.col("text")).alias("_fp"))
    found = marked.join(broadcast_if_small(listed, LISTED_ROWS), (F.col("_fp") == F.col("_fp_of")) & F.col("_id").eqNullSafe(F.col("_id_of")), "left")
    kept = found.filter("_stays IS NULL").select("_row")
    if not listed.filter("_stays").isEmpty():
        kept = kept.union(found.filter("_stays").dropDuplicates(["_fp", "_id"]).select("_row"))
    return kept.select("_row.*")
