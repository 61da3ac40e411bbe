import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from stationtide.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def paths(leaves):
    """Siblings to the left and right, for each leaf and level, and the root."""
    out, level = [[] for _ in leaves], list(leaves)
    at = list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for k, i in enumerate(at):
            out[k].append((runs[i // 8][:i % 8], runs[i // 8][i % 8 + 1:]))
        at, level = [i // 8 for i in at], [h(*r) for r in runs]
    return out, level[0]


def brute(rows):
    """Plain trees over all rows."""
    by = defaultdict(list)
    for row in rows:
        by[row[2]].append(row)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, *paths([leaf(r) for r in own])
    above, root = paths([trees[x][2] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        own, steps, subroot = trees[lang]
        for row, path in zip(own, steps):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            fold = leaf((*row[:4], lower(row[4]))) if hit else leaf(row)
            for left, right in path + above[k]:
                fold = h(*left, fold, *right)
            proof = h(*(x for left, right in path + above[k] for x in left + right))
            out.append((row[0], leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def result(docs):
    return sorted((tuple(r) for r in merkle.audit(docs, merkle.tampered_text()).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 4])
def test_equals_brute_force(frame, monkeypatch, levels):
    monkeypatch.setattr(merkle, "CHUNK_LEVELS", levels)
    monkeypatch.setattr(merkle, "CHUNK", 8 ** levels)
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(700)] + [(1000 + i, "s", f"l{i:03d}", None, "X") for i in range(70)]
    rows += [(2000 + i, None, None, i, "a B") for i in range(65)] + [(3000, "", "é", 0, ""), (3001, "ü", "é", 1, None), (3002, "s", "", 5, "É" * 200_000)]
    rows += [(5, "s", "en", 1, "again"), (5, "s", "en", 1, "again"), (None, "s", "en", 1, "no id"), (None, None, None, None, None), (None, None, None, None, None)]
    docs = frame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS pos", "3 AS leaf", "4 AS n")
    assert result(docs) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_small_trees(frame, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    assert result(frame(rows, SCHEMA)) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = result(docs)
    assert got == brute([tuple(r) for r in docs.collect()])
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_some_rows_fetch_the_smallest_union(frame):
    rows = [(i, "s", "en" if i % 4 else "fr", i, f"Text {i}") for i in range(20_000)]
    manifest = merkle.build(frame(rows, SCHEMA))
    wanted = manifest.leaves.filter("doc_id IN (0, 1, 2, 3, 77, 5000, 19999) OR doc_id BETWEEN 9000 AND 9100").selectExpr("*", "leaf AS claim")
    chosen = {(r.tree, r.pos) for r in wanted.collect()}
    asked = merkle.fetched(manifest, wanted).collect()
    for tree, n in ((0, 15_000), (1, 5_000)):
        for chunk in {p // merkle.CHUNK for t, p in chosen if t == tree}:
            path, want, level, width = {p for t, p in chosen if t == tree and p // merkle.CHUNK == chunk}, set(), 0, n
            while width > 1:
                parents = {p // 8 for p in path}
                want |= {(level, c) for p in parents for c in range(8 * p, min(8 * p + 8, width)) if c not in path}
                path, level, width = parents, level + 1, -(-width // 8)
            assert sorted(want) == sorted((r.level, r.idx) for r in asked if r["at"] == tree and r.chunk == chunk and r.tree == tree)
    want = {r[0]: r[4] for r in brute(rows)}
    got = [(r.doc_id, h(r.proof), r.folded_root) for r in merkle.prove(manifest, wanted).collect()]
    assert len(got) == len(chosen) and all(p == want[i] and f == manifest.root for i, p, f in got)


def test_missing_of_all_is_nothing():
    assert sum(len(i) for _, i in merkle.missing(np.arange(1000), 1000)) == 0
    assert merkle.depth(1) == merkle.depth(0) == 0 and merkle.depth(8) == 1 and merkle.depth(9) == 2


def test_empty_table(frame):
    assert merkle.audit(frame([], SCHEMA), merkle.tampered_text()).count() == 0
