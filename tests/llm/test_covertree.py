import math

import numpy as np
import pytest

from stationtide.llm import covertree


def brute(rows, cosine=0.9):
    """(vec_id, n_links, component, kept) of each row, by all pairs."""
    def unit(v):
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        return np.array(v, float) / np.sqrt((np.array(v, float) ** 2).sum()) if ok else None

    units = [unit(v) for _, v in rows]
    link = [[j for j in range(len(rows)) if j != i and a is not None and units[j] is not None and len(a) == len(units[j]) and float(a @ units[j]) >= cosine]
            for i, a in enumerate(units)]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(link[i]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=str)


def clustered(rng, n, d):
    centres = rng.normal(size=(8, d))
    out = []
    for i in range(n):
        spread = rng.choice([0.01, 0.1, 0.25, 0.35, 1.5])
        out.append((centres[rng.integers(8)] + spread * rng.normal(size=d)) * rng.uniform(0.1, 5))
    return np.array(out)


@pytest.mark.parametrize("block, leaf, chunk", [(8192, 32, 1024), (60, 4, 16)])
def test_matches_all_pairs(frame, monkeypatch, block, leaf, chunk):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    monkeypatch.setattr(covertree, "LEAF", leaf)
    monkeypatch.setattr(covertree, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(clustered(rng, 400, 12))]
    rows += [(1000 + i, rows[7][1]) for i in range(30)] + [(1000, rows[7][1]), (None, rows[9][1]), (None, [9.0] * 11 + [-9.0])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [float("nan")] + [1.0] * 11), (2004, [None] + [1.0] * 11), (2005, [math.inf] + [0.0] * 11), (2006, [1.0, 2.0]), (2007, [2.0, 4.0])]
    frame_rows = frame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cid", "'x' AS v", "vec_id AS n_links")
    assert sorted(map(tuple, covertree.near_vectors(frame_rows).collect()), key=str) == brute(rows)


def test_node_pairs_count_what_pairs_of_points_do():
    rng = np.random.default_rng(2)
    for d, n in ((3, 500), (24, 700)):
        x, y = clustered(rng, n, d), clustered(rng, n // 2, d)
        a, b = covertree.Block(x, rng.integers(1, 5, n), 0.447), covertree.Block(y, rng.integers(1, 5, n // 2), 0.447)
        links = covertree.Links(a, b, 0.9)
        near = a.unit @ b.unit.T >= 0.9
        assert np.array_equal(links.count, np.concatenate([near @ b.weights, near.T @ a.weights]))
        own = covertree.Links(a, None, 0.9)
        near = a.unit @ a.unit.T >= 0.9
        np.fill_diagonal(near, False)
        assert np.array_equal(own.count, near @ a.weights)


def test_dense_group_is_counted_by_nodes(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=64) + 0.02 * rng.normal(size=(3000, 64))
    seen = []
    decide = covertree.Links._decide
    monkeypatch.setattr(covertree.Links, "_decide", lambda self, *a: (seen.append(len(a[2])), decide(self, *a))[1])
    links = covertree.Links(covertree.Block(x, np.ones(3000, np.int64), 0.447), None, 0.9)
    assert (links.count == 2999).all() and not links.parent.any() and sum(seen) < 10_000


def test_tables_and_nothing(spark, frame):
    data = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in data.collect()]
    assert sorted(map(tuple, covertree.near_vectors(data).collect()), key=str) == brute(rows)
    assert covertree.near_vectors(data.limit(0)).count() == 0
    assert covertree.near_vectors(frame([(1, None)], "vec_id long, embedding array<float>")).collect()[0].asDict() == {"vec_id": 1, "n_links": 0, "component_id": 1, "kept": True}
