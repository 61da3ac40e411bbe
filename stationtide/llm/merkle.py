"""Merkle manifest of a table, and proofs for many of its rows at once by octopus multiproofs.

The rows of each language are the leaves of a tree with runs of RUN, in the order of their ids, and the roots of these
trees are the leaves of one more. Trees are built in chunks of CHUNK leaves: a task climbs from the leaves of a chunk to
its top, and the tops are dealt into chunks again, so that a table of any size takes a few rounds and no task sees more
than a chunk. All interior nodes are kept, one for every seven leaves.

To prove rows, each chunk of wanted leaves works out which coordinates its paths need and cannot derive: level by level
the children of the parents on the paths, without those that are on a path themselves. This union is the smallest there
is; it is fetched from the node table by one join. From it and its own leaves a task derives every shared interior node
once, and expands the proof of each leaf without asking for anything else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationtide.llm.common import written
from stationtide.llm.oracles import crc32_sql, crc_table_sql
from stationtide.session import broadcast_if_small

#: Children of a node.
RUN = 8
#: Levels that one task climbs, and the leaves below a node of that height.
CHUNK_LEVELS = 4
CHUNK = RUN ** CHUNK_LEVELS
#: Tree number of the tree over the languages.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(**replaced: Column) -> Column:
    """Digest of a row's COLUMNS, each as its UTF-8 length, a colon and its text, or a dash for null."""
    out = []
    for name in COLUMNS:
        value = replaced.get(name, F.col(name)).cast("string")
        out.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*out), 256)


def depth(n: int) -> int:
    """Levels above ``n`` leaves; none above a lone one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def climb(hashes: list[str]) -> list[str]:
    """The next level above consecutive nodes of which the first starts a run."""
    return [digest(*hashes[i:i + RUN]) for i in range(0, len(hashes), RUN)]


def missing(places: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, indexes) of the nodes that proofs of the leaves at ``places`` (of ``n``) need and cannot derive."""
    path = np.unique(places)
    for level in range(depth(n)):
        parents = np.unique(path // RUN)
        children = (parents[:, None] * RUN + np.arange(RUN)).ravel()
        children = children[children < n]
        yield level, np.setdiff1d(children, path, assume_unique=True)
        path, n = parents, -(-n // RUN)


@dataclass
class Manifest:
    """``leaves`` (tree, pos, n, doc_id, leaf and what was kept beside it), ``nodes`` (tree, level, idx, hash), ``trees`` (tree,
    lang, n, subroot); tree TOP has the subroots as its leaves, which ``nodes`` holds as its level 0."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place``, their rank in the order of the columns ``order`` (null first). Range partitions are written with a
    running number; the driver gets one count for each partition."""
    out = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    counts = sorted((r.part, r.n) for r in out.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in counts)]).tolist()
    offsets = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part long, _before long")
    joined = out.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")


def _climb_chunk(base: int):
    """All levels above a whole chunk of nodes of level ``base``, until one node is left in the chunk or CHUNK_LEVELS are done."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        tree, chunk, n = key[0].as_py(), key[1].as_py(), rows["n"][0].as_py()
        hashes, level, out = rows["hash"].to_pylist(), base, []
        for _ in range(min(CHUNK_LEVELS, depth(n) - base)):
            hashes, level = climb(hashes), level + 1
            first = chunk * RUN ** (CHUNK_LEVELS + base - level)
            out += [(level, first + i, h) for i, h in enumerate(hashes)]
        return pa.table({"tree": pa.array([tree] * len(out), pa.int64()), "level": pa.array([x[0] for x in out], pa.int32()),
                         "idx": pa.array([x[1] for x in out], pa.int64()), "hash": pa.array([x[2] for x in out], pa.string()), "n": pa.array([n] * len(out), pa.int64())})

    return run


def grown(leaves: DataFrame, most: int) -> DataFrame:
    """All nodes above ``leaves`` (tree, pos, n, hash), where no tree has more than ``most`` leaves."""
    rows, out, base = leaves.select("tree", "pos", "n", "hash"), None, 0
    while True:
        chunks = rows.withColumn("chunk", F.expr(f"pos DIV {CHUNK}")).groupBy("tree", "chunk")
        nodes = written(chunks.applyInArrow(_climb_chunk(base), "tree long, level int, idx long, hash string, n long"), "nodes")
        out, base = nodes if out is None else out.union(nodes), base + CHUNK_LEVELS
        if depth(most) <= base:
            return out
        rows = nodes.filter(F.col("level") == base).select("tree", F.col("idx").alias("pos"), "n", "hash")


def build(docs: DataFrame, **beside: Column) -> Manifest:
    """Manifest of ``docs`` (COLUMNS). ``beside`` are further expressions over a row to be kept with its leaf.

    Null values are told apart from empty ones; a null language has a tree of its own, rows without doc_id come first in
    theirs; rows that repeat an id are ordered by their digest, equal rows are leaves of their own; an empty table has no
    tree and no root. Other columns are not read.
    """
    own = docs.select(*(F.col(c) for c in COLUMNS))
    raw = written(own.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_of().alias("leaf"),
                             *(value.alias(name) for name, value in beside.items())).withColumn("_salt", F.monotonically_increasing_id()), "leaves")
    langs = placed(raw.groupBy("lang").agg(F.count("*").alias("n")), ["lang"], "langs").withColumnRenamed("place", "tree")
    langs = written(langs, "langs").withColumnRenamed("lang", "_lang")
    n_trees, most = langs.agg(F.count("*"), F.max("n")).first()
    # Starts of the trees in the order of all leaves come from the places themselves.
    small = broadcast_if_small(langs.select("_lang", "tree", "n"))
    rows = placed(raw.join(small, F.col("lang").eqNullSafe(F.col("_lang"))).drop("lang", "_lang"), ["tree", "doc_id", "leaf", "_salt"], "leaves")
    starts = rows.groupBy("tree").agg(F.min("place").alias("_start"))
    leaves = written(rows.join(broadcast_if_small(starts), "tree").withColumn("pos", F.col("place") - F.col("_start")).drop("place", "_start", "_salt"), "leaves")
    nodes = grown(leaves.withColumnRenamed("leaf", "hash"), most or 0)
    lone = leaves.filter("n = 1").select("tree", F.col("leaf").alias("hash"))
    tops = nodes.filter(F.col("level") == _depth(F.col("n"))).select("tree", "hash").union(lone)
    trees = written(tops.withColumnRenamed("hash", "subroot").join(langs.withColumnRenamed("_lang", "lang"), "tree"), "trees")
    first = trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("n"), F.col("subroot").alias("hash"))
    above = grown(first, n_trees)
    root = first.filter("n = 1").select("hash").union(above.filter(F.col("level") == depth(n_trees)).select("hash")).first()
    every = nodes.drop("n").union(first.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "hash")).union(above.drop("n"))
    return Manifest(leaves, every, trees, n_trees, root[0] if root else None)


def _depth(n: Column) -> Column:
    """``depth`` as a column: the powers of RUN below n are counted, as logarithms round."""
    return sum(((n > F.lit(RUN ** k).cast("long")).cast("int") for k in range(20)), F.lit(0))


def _coordinates(n_trees: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        tree, chunk, n = key[0].as_py(), key[1].as_py(), rows["n"][0].as_py()
        found = [(tree, level, idx) for level, idx in missing(rows["pos"].to_numpy(), n)]
        found += [(TOP, level, idx) for level, idx in missing(np.array([tree]), n_trees)]
        count = [len(idx) for *_, idx in found]
        each = lambda values, kind: pa.array(np.repeat(np.array(values, np.int64), count), pa.int64()).cast(kind)
        total = sum(count)
        return pa.table({"at": pa.array([tree] * total, pa.int64()), "chunk": pa.array([chunk] * total, pa.int64()), "tree": each([t for t, *_ in found], pa.int64()),
                         "level": each([x[1] for x in found], pa.int32()), "idx": pa.array(np.concatenate([np.zeros(0, np.int64), *(x[2] for x in found)]))})

    return run


def fetched(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """``at``, ``chunk`` (who asks), ``tree``, ``level``, ``idx``, ``hash``: the union of missing nodes of each chunk of ``wanted``."""
    chunks = wanted.select("tree", "pos", "n").withColumn("chunk", F.expr(f"pos DIV {CHUNK}")).groupBy("tree", "chunk")
    asked = written(chunks.applyInArrow(_coordinates(manifest.n_trees), "at long, chunk long, tree long, level int, idx long"), "asked")
    keys, lowest = ["tree", "level", "idx"], asked.agg(F.min("level")).first()[0]
    # Levels that nobody asks for are not read.
    out = manifest.nodes.filter(F.col("level") >= (lowest or 0)).join(broadcast_if_small(asked), keys)
    at_leaves = asked.filter((F.col("level") == 0) & (F.col("tree") != TOP))
    if not at_leaves.isEmpty():
        leaves = manifest.leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("hash"))
        out = out.unionByName(leaves.join(broadcast_if_small(at_leaves), keys))
    return out.select("at", "chunk", *keys, "hash")


def _sides(known: dict[int, str], n: int) -> tuple[dict[int, tuple[str, str]], dict[int, str]]:
    """Siblings to the left and right of each node, and the nodes above; ``known`` has whole runs."""
    sides, above = {}, {}
    for parent in {i // RUN for i in known}:
        run = [known[i] for i in range(parent * RUN, min(parent * RUN + RUN, n))]
        above[parent] = digest(*run)
        for k in range(len(run)):
            sides[parent * RUN + k] = "".join(run[:k]), "".join(run[k + 1:])
    return sides, above


def _expand(n_trees: int):
    """Proofs of the leaves of a chunk from themselves and the nodes that were fetched for it."""
    def run(key: tuple, rows: pa.Table, more: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        given: dict[tuple[int, int], dict[int, str]] = {}
        for t, level, idx, h in zip(*(more[c].to_pylist() for c in ("tree", "level", "idx", "hash"))):
            given.setdefault((t, level), {})[idx] = h
        places, leaves, claims = (rows[c].to_pylist() for c in ("pos", "leaf", "claim"))
        steps = []  # for each level of the path: the siblings by index
        own = dict(zip(places, leaves))
        for t, n in ((tree, rows["n"][0].as_py() if rows.num_rows else 0), (TOP, n_trees)):
            if t == TOP:
                own = {tree: subroot}
            for level in range(depth(n)):
                sides, own = _sides(own | given.get((t, level), {}), n)
                steps.append((sides, t == TOP, RUN ** level))
                n = -(-n // RUN)
            if t != TOP:
                (subroot,) = own.values()
        proofs, folds = [], []
        for place, claim in zip(places, claims):
            parts = []
            for sides, top, width in steps:
                left, right = sides[(tree if top else place) // width]
                parts += (left, right)
                claim = digest(left, claim, right)
            proofs.append("".join(parts))
            folds.append(claim)
        return pa.table({"doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": pa.array([subroot] * len(places), pa.string()),
                         "proof": pa.array(proofs, pa.string()), "folded_root": pa.array(folds, pa.string())})

    return run


def prove(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``proof``, ``folded_root`` of each row of ``wanted`` (tree, pos, n, doc_id, leaf, claim), which are
    rows of the manifest's leaves with the digest that somebody claims for each.

    ``proof`` are the digests of the siblings, level by level from the leaf to the root and from left to right, one after the
    other, 64 letters each; ``folded_root`` is what the claimed leaf and the siblings fold to.
    """
    more = fetched(manifest, wanted).groupBy("at", "chunk")
    rows = wanted.select("tree", F.expr(f"pos DIV {CHUNK}").alias("chunk"), "pos", "n", "doc_id", "leaf", "claim").groupBy("tree", "chunk")
    return rows.cogroup(more).applyInArrow(_expand(manifest.n_trees), "doc_id long, leaf string, subroot string, proof string, folded_root string")


def audit(docs: DataFrame, claimed_text: Column) -> DataFrame:
    """Proof digest and verification of every row of ``docs`` against its manifest, where the text is claimed to be ``claimed_text``.

    ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``; one row for each row of ``docs``.
    """
    manifest = build(docs, claim=leaf_of(text=claimed_text))
    proven = prove(manifest, manifest.leaves)
    root = F.lit(manifest.root).cast("string")
    return proven.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))


def tampered_text() -> Column:
    """The text, its letters A-Z in lower case where 3 divides the checksum of the decimal id."""
    low = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, low).otherwise(F.col("text"))


def oracle_sql(levels: int = 8, top_levels: int = 4) -> str:
    """The same by windows over whole levels, for at most 8**levels rows of a language and 8**top_levels languages."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def climbed(tree: str, first: str, steps: int, key: str, on: str, prefix: str) -> str:
        out = [f"{prefix}n0 AS (SELECT {key} i, h FROM {tree}), {prefix}f0 AS (SELECT * FROM {first})"]
        by = f"PARTITION BY {key} i // 8 ORDER BY i ROWS BETWEEN"
        for k in range(steps):
            out.append(f"""{prefix}s{k} AS (SELECT {key} i, h, count(*) OVER ({'PARTITION BY lang' if key else ''}) AS n,
  coalesce(string_agg(h, '') OVER ({by} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER ({by} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}n{k}),
{prefix}n{k + 1} AS (SELECT {key} i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {prefix}s{k} GROUP BY {key} i // 8),
{prefix}f{k + 1} AS (SELECT f.* EXCLUDE (f, proof), CASE WHEN s.n > 1 THEN sha256(s.l || f.f || s.r) ELSE f.f END AS f, f.proof || s.l || s.r AS proof
  FROM {prefix}f{k} f JOIN {prefix}s{k} s ON {on} s.i = f.{'i' if key else 'tree'} // {8 ** k})""")
        return ",\n".join(out)

    leaf = " || ".join(field(c) for c in COLUMNS)
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH crc AS ({crc_table_sql()}),
d AS (SELECT doc_id, source, lang, n_chars, text, {crc32_sql('doc_id::VARCHAR')} % 3 = 0 AS hit FROM documents, crc),
g AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, doc_id, sha256({leaf}) AS h,
  sha256({leaf.replace(field('text'), field(f"(CASE WHEN hit THEN {low} ELSE text END)"))}) AS claim FROM d),
start AS (SELECT lang, i, doc_id, h AS leaf, claim AS f, '' AS proof FROM g),
{climbed('g', 'start', levels, 'lang,', 'f.lang IS NOT DISTINCT FROM s.lang AND', 'a')},
roots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM an{levels}),
lifted AS (SELECT f.*, r.h AS subroot, r.i AS tree FROM af{levels} f JOIN roots r ON r.lang IS NOT DISTINCT FROM f.lang),
{climbed('roots', 'lifted', top_levels, '', '', 'b')}
SELECT f.doc_id, f.leaf, f.subroot, n.h AS root, sha256(f.proof) AS proof_sha256, f.f AS folded_root, f.f = n.h AS verified FROM bf{top_levels} f, bn{top_levels} n
"""
