"""Exact cosine links between vectors by walking two cover trees together.

On unit vectors a cosine of at least c is a distance of at most t = sqrt(2 - 2c). The top of the tree is a bounded set of
pivots: every vector goes to its nearest one, large cells are cut into blocks, and two blocks meet in a task only
where pivot distance and covering radii allow a link; a vector goes there only if its own distance to the other pivot
does. In the task nested nets with radii t, t/2, t/4 ... are built over each block and node pairs are walked from the top: a
pair whose distance exceeds t by more than both covering radii is dropped, one whose members must all link is counted
whole, and pairs of points are decided in double precision. Tasks return a count and one link for each vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import written
from stationtide.llm.components import connected_components, merge_labels

#: Vectors of a block; a task holds two blocks.
BLOCK_ROWS = 8192
#: Pivots at the top; the sample they are chosen from has four times as many vectors.
MAX_PIVOTS = 1024
LEAF = 32
#: Rows of a distance table that is held at once.
CHUNK = 256
#: What a vector is in its task: one of the block that meets itself, of the first or of the second of two.
ALONE, FIRST, SECOND = 0, 1, 2
SLACK = np.float32(1e-5)  # of single precision, only ever used to look at more pairs


@dataclass
class Node:
    """Children of a tree node: of each a centre, a covering radius, whether it is a single point, its members, and the
    node below it if it is not."""

    centres: np.ndarray
    radii: np.ndarray
    points: np.ndarray
    members: list = field(default_factory=list)
    below: list = field(default_factory=list)


class Block:
    """Vectors with their multiplicities, and a cover tree over them whose first net has the given radius. Coarser nets
    inside a block would prune little: the pivots stand above them."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, radius: float):
        self.raw = vectors
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        self.unit = vectors / self.norm[:, None]
        self.fast = self.unit.astype(np.float32)
        self.weights = weights
        self.root = self._grow(np.arange(len(vectors)), radius)

    def _grow(self, members: np.ndarray, radius: float) -> Node:
        if len(members) <= LEAF or radius < 1e-3:
            return Node(members, np.zeros(len(members)), np.ones(len(members), bool), [members[i:i + 1] for i in range(len(members))], [None] * len(members))
        centres, owner = self._net(members, radius)
        node = Node(centres, np.zeros(len(centres)), np.bincount(owner) == 1)
        order = np.argsort(owner, kind="stable")
        for k, own in enumerate(np.split(members[order], np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1])):
            node.members.append(own)
            if len(own) == 1:
                node.below.append(None)
                continue
            gap = self.unit[own] - self.unit[centres[k]]
            node.radii[k] = math.sqrt((gap * gap).sum(axis=1).max()) + 1e-9
            node.below.append(self._grow(own, radius / 2))
        return node

    def _net(self, members: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Points more than about ``radius`` apart, such that each member is within ``radius`` of the one that owns it."""
        near = 1 - radius * radius / 2
        centres: list[int] = []
        owner = np.full(len(members), -1)
        for at in range(0, len(members), CHUNK):
            own = members[at:at + CHUNK]
            if centres:
                cos = self.fast[own] @ self.fast[centres].T
                best = cos.argmax(axis=1)
                covered = cos[np.arange(len(own)), best] >= near
                owner[at:at + CHUNK][covered] = best[covered]
            left = np.flatnonzero(owner[at:at + CHUNK] < 0)
            close = self.fast[own[left]] @ self.fast[own[left]].T >= near
            free = np.ones(len(left), bool)
            for i in range(len(left)):
                if free[i]:
                    close[i, i] = True
                    taken = free & close[i]
                    owner[at + left[taken]] = len(centres)
                    free &= ~taken
                    centres.append(int(own[left[i]]))
        return np.array(centres), owner


class Links:
    """Links between two blocks, or inside one: what each vector links to, and who is connected."""

    def __init__(self, a: Block, b: Block | None, cosine: float):
        self.a, self.b, self.cosine = a, b or a, cosine
        self.t = math.sqrt(max(0.0, 2 - 2 * cosine))
        self.shift = 0 if b is None else len(a.raw)
        n = len(a.raw) + (0 if b is None else len(b.raw))
        self.count = np.zeros(n, np.int64)
        self.parent = np.arange(n)
        stack = [(a.root, self.b.root)]
        while stack:
            stack += self._walk(*stack.pop())

    def _walk(self, x: Node, y: Node) -> list[tuple[Node, Node]]:
        deeper = []
        own = x is y and self.shift == 0
        for at in range(0, len(x.centres), CHUNK):
            rows = slice(at, at + CHUNK)
            cos = self.a.fast[x.centres[rows]] @ self.b.fast[y.centres].T
            reach = np.minimum(x.radii[rows, None].astype(np.float32) + (y.radii + self.t).astype(np.float32), np.float32(2))
            keep = cos >= 1 - SLACK - reach * reach / 2
            if own:
                keep &= np.arange(len(y.centres))[None, :] >= np.arange(at, at + len(cos))[:, None]
            i, j = np.nonzero(keep)
            i += at
            for part in range(0, len(i), 65536):
                deeper += self._decide(x, y, i[part:part + 65536], j[part:part + 65536], own)
        return deeper

    def _decide(self, x: Node, y: Node, i: np.ndarray, j: np.ndarray, own: bool) -> list[tuple[Node, Node]]:
        p, q = x.centres[i], y.centres[j]
        dot = np.einsum("ij,ij->i", self.a.raw[p], self.b.raw[q]) / (self.a.norm[p] * self.b.norm[q])
        points = x.points[i] & y.points[j]
        same = (i == j) & own
        link = points & (dot >= self.cosine) & ~same
        if link.any():
            np.add.at(self.count, p[link], self.b.weights[q[link]])
            np.add.at(self.count, q[link] + self.shift, self.a.weights[p[link]])
            merge_labels(self.parent, p[link], q[link] + self.shift)
        deeper = []
        for k in np.flatnonzero(~points):
            gap = 0.0 if same[k] else math.sqrt(max(0.0, 2 - 2 * dot[k]))
            ri, rj = x.radii[i[k]], y.radii[j[k]]
            if gap + ri + rj <= self.t - 1e-6:
                self._all(x.members[i[k]], y.members[j[k]], bool(same[k]))
            else:
                deeper.append((_below(x, i[k]), _below(y, j[k])))
        return deeper

    def _all(self, u: np.ndarray, v: np.ndarray, same: bool) -> None:
        """Every member of one node links to every member of the other."""
        if same:
            self.count[u] += self.a.weights[u].sum() - self.a.weights[u]
        else:
            self.count[u] += self.b.weights[v].sum()
            self.count[v + self.shift] += self.a.weights[u].sum()
        together = np.concatenate([u, v + self.shift])
        merge_labels(self.parent, together, np.full(len(together), together[0]))


def _below(node: Node, k: int) -> Node:
    if node.below[k] is None:
        return Node(node.centres[k:k + 1], np.zeros(1), np.ones(1, bool), [node.members[k]], [None])
    return node.below[k]


@dataclass(frozen=True)
class Top:
    """Pivots of one vector length, and the covering radius and the number of blocks of each cell."""

    pivots: np.ndarray
    radii: np.ndarray
    blocks: np.ndarray

    @property
    def cells(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.blocks)), self.blocks)

    def meets(self, t: float) -> np.ndarray:
        """Which blocks can hold links to which."""
        gap = np.sqrt(np.maximum(0, 2 - 2 * self.pivots @ self.pivots.T)) <= t + self.radii[:, None] + self.radii[None, :] + 1e-6
        return gap[np.ix_(self.cells, self.cells)]


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _spread_out(units: np.ndarray, k: int) -> np.ndarray:
    """k of the rows, each the farthest from those before."""
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < min(k, len(units)):
        at = int(nearest.argmin())
        chosen.append(at)
        nearest = np.maximum(nearest, units @ units[at])
    return units[chosen]


def usable(column: str):
    """Vectors that have a direction: neither null, empty nor zero, and no null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(column, finite) & F.exists(column, lambda x: x != 0), F.lit(False))


def link_classes(classes: DataFrame, cosine: float) -> DataFrame:
    """``cid``, ``n``, ``root`` rows for ``classes`` (cid, m, v: different usable vectors with multiplicities): summed over
    its rows, n counts the vectors of other classes that cid links to; the (cid, root) links connect what links."""
    t = math.sqrt(max(0.0, 2 - 2 * cosine))
    empty = classes.sparkSession.createDataFrame([], "cid long, n long, root long")
    found = empty
    sizes = {r.d: r["count"] for r in classes.groupBy(F.size("v").alias("d")).count().collect()}
    for d, n in sorted(sizes.items()):
        own = classes.filter(F.size("v") == d)
        k = min(MAX_PIVOTS, -(-n // BLOCK_ROWS))
        sample = own.select("v").orderBy(F.xxhash64("v"), "v").limit(4 * k).toArrow()
        pivots = _spread_out(_units(_vectors(sample["v"])), k)
        homes = written(own.mapInArrow(_home(pivots), "cid long, m long, v array<double>, cell int, gap double"), "homes")
        cells = {r.cell: r for r in homes.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect()}
        top = Top(pivots, np.array([cells[c].r if c in cells else 0.0 for c in range(k)]),
                  np.array([-(-cells[c].n // BLOCK_ROWS) if c in cells else 0 for c in range(k)]))
        met = homes.mapInArrow(_send(top, t), "pair long, side int, cid long, m long, v array<double>").groupBy("pair")
        found = found.union(met.applyInArrow(_meet(cosine), "cid long, n long, root long"))
    return found


def _home(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cos = _units(_vectors(batch.column("v"))) @ pivots.T
                cell = cos.argmax(axis=1)
                gap = np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(cell)), cell])) + 1e-7
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cid", "m", "v")), pa.array(cell.astype(np.int32)), pa.array(gap)],
                                                 ["cid", "m", "v", "cell", "gap"])

    return run


def _send(top: Top, t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, meets = top.cells, top.meets(t)
        first = np.concatenate(([0], np.cumsum(top.blocks)))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                cell, cid = part.column("cell").to_numpy(), part.column("cid").to_numpy()
                node = first[cell] + cid % top.blocks[cell]
                gap = np.sqrt(np.maximum(0, 2 - 2 * _units(_vectors(part.column("v"))) @ top.pivots.T))
                goes = meets[node] & (gap <= t + top.radii + 1e-6)[:, cells]
                goes[np.arange(len(node)), node] = True
                rows, others = np.nonzero(goes)
                for cut in range(0, len(rows), 16384):
                    r, o = rows[cut:cut + 16384], others[cut:cut + 16384]
                    own = node[r]
                    pair = np.minimum(own, o) * len(cells) + np.maximum(own, o)
                    taken = part.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.where(own == o, ALONE, np.where(own < o, FIRST, SECOND)).astype(np.int32)), *(taken.column(c) for c in ("cid", "m", "v"))],
                                                     ["pair", "side", "cid", "m", "v"])

    return run


def _meet(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by("side")
        side = order["side"].to_numpy()
        cid, m, v = order["cid"].to_numpy(), order["m"].to_numpy(), _vectors(order["v"])
        cut = int(np.searchsorted(side, SECOND))
        some, root = np.zeros(0, np.int64), np.zeros(0, np.int64)
        count = some
        if side[0] == ALONE or 0 < cut < len(side):
            t = math.sqrt(max(0.0, 2 - 2 * cosine))
            a = Block(v[:cut], m[:cut], t)
            links = Links(a, Block(v[cut:], m[cut:], t) if cut < len(side) else None, cosine)
            some = np.flatnonzero(links.count)
            count, root = links.count[some], cid[links.parent[some]]
        return pa.table({"cid": cid[some], "n": count, "root": root})

    return run


def near_vectors(embeddings: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``embeddings`` (vec_id, embedding).

    Two vectors link when their cosine in double precision is at least ``cosine``. Null, empty and zero vectors, vectors
    with a null or non-finite component, and vectors of different lengths link with nothing; alone, a row is its own
    component. Equal vectors are one class with a multiplicity, so that a large group of copies costs one row; they link
    with one another, repeated ids included. A row without vec_id takes part and keeps its null; a component without
    any id has a null one. An empty table gives an empty result; other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = rows.filter(usable("v"))
    classes = written(good.groupBy("v").agg(F.count("*").alias("m"), F.min("vec_id").alias("first")).withColumn("cid", F.monotonically_increasing_id()), "classes")
    links = written(link_classes(classes.select("cid", "m", "v"), cosine), "links")
    members = connected_components(links.select(F.col("cid").alias("u"), F.col("root").alias("v"))).withColumnRenamed("id", "cid")
    firsts = classes.select("cid", "m", "first")
    linked = members.join(firsts, "cid")
    named = linked.join(linked.groupBy("component").agg(F.min("first").alias("least")), "component").select("cid", "least")
    counts = links.groupBy("cid").agg(F.sum("n").alias("n"))
    found = (classes.join(counts, "cid", "left").join(named, "cid", "left")
             .select("v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id")))
    marked = good.join(found, "v").select("vec_id", "n_links", "component_id")
    others = rows.filter(~usable("v")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return marked.union(others).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
