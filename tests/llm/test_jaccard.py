import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationtide.llm import jaccard, simhash


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    """Ids of the first row of each group of texts with a five-word Jaccard similarity of 0.8 or more."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or min(len(a), len(b)) * 5 >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                links += a != b
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values()), links


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("block, texts", [(2_000_000, 3_000), (1500, 7)])
def test_stage_equals_brute_force_on_edited_copies(spark, frame, monkeypatch, block, texts):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", texts)
    rng = random.Random(2)
    passage = [f"common{k}" for k in range(60)]
    rows = []
    for n in (3, 5, 6, 9, 14, 40, 120, 150, 400, 1200):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(14):
            rows.append((len(rows), " ".join(edited(rng, base, rng.randint(0, max(1, n // 30))))))
        for _ in range(6):
            rows.append((len(rows), " ".join(passage + [f"w{rng.randrange(5000)}" for _ in range(n)])))
    rng.shuffle(rows)
    want, links = brute_kept(rows)
    got = sorted(r.doc_id for r in simhash.keep_one_of_each(frame(rows, "doc_id long, text string")).collect())
    assert links > 300 and got == want


def test_stage_equals_brute_force_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, links = brute_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert links and sorted(r.doc_id for r in simhash.keep_one_of_each(docs).collect()) == want


def test_sketches_part_and_keys_meet():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 90, 134, 135, 3000):
        for _ in range(30):
            both = rng.integers(0, 1 << 64, n, np.uint64)
            own = int(n / 0.8 - n + 1e-9)  # a pair at the threshold
            cut = rng.integers(0, own + 1)
            extra = rng.integers(0, 1 << 64, own, np.uint64)
            a, b = (np.unique(np.concatenate([both, x])) for x in (extra[:cut], extra[cut:]))
            assert np.isin(jaccard.keys_of(a), jaccard.keys_of(b)).any()
            x, y = (np.frombuffer(jaccard.sketch(s), np.uint8) for s in (a, b))
            assert np.count_nonzero(x == y) >= jaccard.AGREE
    a, b = (np.frombuffer(jaccard.sketch(rng.integers(0, 1 << 64, 500, np.uint64)), np.uint8) for _ in range(2))
    assert np.count_nonzero(a == b) < 10


def test_a_bucket_of_unlike_texts_is_many_groups(spark, frame, monkeypatch):
    """Texts that share one common smallest shingle and nothing else meet in blocks, each pair of which is a group of its own."""
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 50)
    rows = [(i, i, 40, [7, 1000 + i], b"x" * jaccard.SKETCH) for i in range(600)]
    leaves = frame(rows, "fp long, first long, n long, keys array<long>, sketch binary")
    postings = leaves.selectExpr("fp", "explode(keys) AS key").filter("key = 7").selectExpr("*", "12L AS blocks")
    groups = jaccard._in_pairs_of_blocks(postings)
    sizes = [r["count"] for r in groups.groupBy("key", "i", "j").count().collect()]
    assert len(sizes) == 12 * 11 // 2 and max(sizes) < 200
    met = {(r.fp, r.i, r.j) for r in groups.collect()}
    places = {fp: {(i, j) for f, i, j in met if f == fp} for fp in range(0, 600, 37)}
    assert all(places[a] & places[b] for a in places for b in places)


def test_identity_is_the_same_in_both_forms(frame):
    texts = ["", None, " ", "\t\n\x0b\x0c\r", "A b  C\n", " a B c", "É é\u00a0x", "one", "x" * 70_000, "\u2003 a"]
    got = [r.h for r in frame([(t,) for t in texts], "text string").select(jaccard.identity(F.col("text")).alias("h")).collect()]
    assert got == jaccard.identities(texts).tolist()
