"""Pairs of texts whose sets of five-word shingles have a Jaccard similarity of LEAST or more, enough of them to connect all.

A pair's smallest shingle hashes agree: of n shingles the n - ceil(LEAST n) + 1 smallest hold one of any partner's, and of
two such sets the KEYS smallest have none in common with a chance below 2**-64. Texts meet in the buckets of these keys.
There sketches of min-hashes part the unlike ones (a pair at LEAST is taken for unlike with a chance of about 2**-64), and
what is left connects to rough clusters. Only the texts of a cluster are read again, and their whole sets are compared.
No step emits the pairs of a group: buckets and clusters give a spanning forest. A bucket of many texts, and a cluster of many
shingles, is dealt out as pairs of blocks, so that no key and no group is one task, and every pair still meets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stationtide.llm.common import ids_and_texts, written
from stationtide.llm.components import connected_components
from stationtide.session import broadcast_if_small

SEED = 42
WORDS = 5
LEAST = 0.8
KEYS = 28
#: Min-hashes of a sketch, one byte each, and how many of them agree at least in a pair that is looked at further.
SKETCH = 128
AGREE = 54
#: Texts of a bucket that are a block; larger buckets are dealt out as pairs of blocks.
BLOCK_TEXTS = 3_000
#: Shingles of a cluster that are compared together; larger clusters are dealt out as pairs of blocks.
BLOCK_SHINGLES = 2_000_000
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 64, SKETCH, np.uint64) | np.uint64(1)


def shingle_hashes(text: str | None, n: int) -> list[int]:
    """XXH64 of each shingle of n words, repeats included; a text with fewer words has one shingle, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-n])).tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[n - 1:] - 1).tolist())]


def identities(texts: list[str | None]) -> np.ndarray:
    """XXH64 of each text's words, as signed integers; case and white space aside, equal texts have equal ones."""
    words = (b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split()) for t in texts)
    return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(texts)).view(np.int64)


def identity(text: Column) -> Column:
    """``identities`` as a built-in expression."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " ")))


def shingle_set(text: str | None) -> np.ndarray:
    """Different shingle hashes, ascending."""
    return np.unique(np.array(shingle_hashes(text, WORDS), np.uint64))


def keys_of(own: np.ndarray) -> np.ndarray:
    return own[:min(KEYS, len(own) - int(np.ceil(LEAST * len(own) - 1e-9)) + 1)]


def sketch(own: np.ndarray) -> bytes:
    """One byte of the smallest product with each multiplier."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    for at in range(0, len(own), 2000):
        np.minimum(least, (own[at:at + 2000, None] * MULTIPLIERS).min(axis=0), out=least)
    return ((least >> np.uint64(16)) & np.uint64(255)).astype(np.uint8).tobytes()


def describe(docs: DataFrame, marks: Callable[[list], np.ndarray]) -> DataFrame:
    """``doc_id``, ``fp`` (identity), ``n`` (shingles), ``keys``, ``sketch`` and ``mark`` of each row. ``marks`` gives an unsigned
    64-bit integer for each text of a list; ``mark`` has its bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=1_000_000):
                sets = [shingle_set(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(identities(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([keys_of(s).view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([sketch(s) for s in sets], pa.binary()),
                    pa.array(marks(texts).view(np.int64)),
                ], ["doc_id", "fp", "n", "keys", "sketch", "mark"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, fp long, n long, keys array<long>, sketch binary, mark long")


def links(docs: DataFrame, leaves: DataFrame) -> DataFrame:
    """``u``, ``v``: enough pairs of LEAST or more to connect all such identities. ``leaves`` (fp, first, n, keys, sketch) has a
    row for each identity in ``docs`` (doc_id, text), with its smallest doc_id."""
    postings = leaves.select("fp", F.explode("keys").alias("key"))
    shared = postings.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key", F.ceil(F.col("c") / BLOCK_TEXTS).alias("blocks"))
    met = _in_pairs_of_blocks(postings.join(shared, "key").join(leaves.select("fp", "n", "sketch"), "fp"))
    dealt = met.select("key", F.col("i").cast("int"), F.col("j").cast("int"), "n", "fp", "sketch")
    rough = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n").mapInArrow(_alike, "u long, v long")
    members = written(connected_components(rough.distinct()).withColumnRenamed("id", "fp").join(leaves.select("fp", "first", "n"), "fp"), "clusters")
    firsts = broadcast_if_small(members.select(F.col("first").alias("doc")).distinct())
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = own.join(firsts, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi").mapInArrow(_sets, "fp long, shingles binary")
    blocks = members.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    placed = sets.join(members.select("fp", "component"), "fp").dropDuplicates(["fp"]).join(blocks, "component")
    dealt = _in_pairs_of_blocks(placed).select("component", "i", "j", "fp", "shingles")
    return dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(_similar, "u long, v long").distinct()


def _in_pairs_of_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (fp, blocks) with ``i``, ``j``: blocks i < j of a group meet in (i, j), and the only block of a group is in (0, 1)."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("blocks") - 1, F.lit(1).cast("long"))))
    both = rows.withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("blocks"))).withColumn("_other", other).filter("_own <> _other")
    return both.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in ids_and_texts(batch, max_chars=1_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(identities(texts)), pa.array([shingle_set(t).tobytes() for t in texts], pa.binary())], ["fp", "shingles"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``keys``, of batches that are sorted by them."""
    kept: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        edges = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(c[a] for c in columns)
            if kept and key != before:
                yield pa.Table.from_batches(kept)
                kept = []
            before = key
            kept.append(batch.slice(a, b - a))
    if kept:
        yield pa.Table.from_batches(kept)


def _forest(n: int, near) -> tuple[list[int], list[int]]:
    """Links that span the components of 0..n-1; ``near(i, others)`` says which of ``others`` i links with. A reached one is never
    compared again, but with those that nothing has reached."""
    waiting, u, v = np.arange(n), [], []
    while len(waiting) > 1:
        front, waiting = [int(waiting[0])], waiting[1:]
        while front and len(waiting):
            i = front.pop()
            hit = near(i, waiting)
            reached = waiting[hit].tolist()
            u += [i] * len(reached)
            v += reached
            front += reached
            waiting = waiting[~hit]
    return u, v


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each pair of blocks of a bucket, between sketches that agree in AGREE places and sets whose sizes allow LEAST."""
    out_u, out_v = [], []
    for group in _groups(batches, ["key", "i", "j"]):
        fp, n = group["fp"].to_numpy(), group["n"].to_numpy()
        marks = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            m = n[others]
            hit = np.minimum(m, n[i]) >= LEAST * np.maximum(m, n[i]) - 1e-6
            some = np.flatnonzero(hit)
            for at in range(0, len(some), 4096):
                part = some[at:at + 4096]
                hit[part] = np.count_nonzero(marks[others[part]] == marks[i], axis=1) >= AGREE
            return hit

        u, v = _forest(len(fp), near)
        out_u.append(fp[u])
        out_v.append(fp[v])
        if sum(map(len, out_u)) > 50_000 or len(out_u) > 5_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], ["u", "v"])
            out_u, out_v = [], []
    if out_u:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], ["u", "v"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each group of whole sets, at a Jaccard similarity of LEAST or more."""
    for group in _groups(batches, ["component", "i", "j"]):
        fp = group["fp"].to_numpy()
        raw = group["shingles"].to_pylist()
        size = np.array([len(r) // 8 for r in raw], np.int64)
        values, codes = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)
        ends = np.cumsum(size)
        starts = ends - size
        table = np.zeros(len(values), bool)
        state = {}

        def near(i: int, others: np.ndarray) -> np.ndarray:
            # The codes of those that wait are gathered anew only when their number has halved.
            if not state or 2 * len(others) <= len(state["rows"]):
                state["rows"] = others
                state["flat"] = np.concatenate([codes[starts[k]:ends[k]] for k in others.tolist()])
                state["at"] = np.concatenate(([0], np.cumsum(size[others])[:-1]))
            own = codes[starts[i]:ends[i]]
            table[own] = True
            both = np.add.reduceat(table[state["flat"]], state["at"], dtype=np.int64)
            table[own] = False
            both = both[np.searchsorted(state["rows"], others)]
            return both >= LEAST * (size[others] + size[i] - both) - 1e-6

        u, v = _forest(len(fp), near)
        yield pa.RecordBatch.from_arrays([pa.array(fp[u]), pa.array(fp[v])], ["u", "v"])
