import numpy as np
import pytest
import xxhash

from stationtide.llm import simhash
from stationtide.llm.components import connected_components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, marks):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_matches_brute_force(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(9001, None), (9002, ""), (9003, " \t"), (9003, " \t"), (None, "a b c d"), (9004, "A b C d"), (9005, "one"), (9006, "é É x"), (9007, "w " * 50_000)]
    got = sorted(map(str, simhash.near_duplicates(frame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component_id")).collect()))
    marks = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([d for d, _ in rows], marks)
    assert got == sorted(str_row(d, f"{m:016x}", c) for (d, _), m, c in zip(rows, marks, want))


def str_row(doc_id, fingerprint, component_id):
    return f"Row(doc_id={doc_id!r}, fingerprint={fingerprint!r}, component_id={component_id!r})"


@pytest.mark.parametrize("bucket", [100_000, 5])
def test_trie_keeps_every_component(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_LEAVES", bucket)
    monkeypatch.setattr(simhash, "FRONTIER", 500)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    seeds[30:] = (seeds[30:] & ((1 << 30) - 1)) | (0x5A5A5A5A << 30)  # many leaves below the same prefixes
    values = set()
    for s in seeds.tolist():
        for _ in range(25):
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                s ^= 1 << b
            values.add(s & (1 << 64) - 1)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.trie_links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    pairs = [(r.u, r.v) for r in links.collect()]
    assert all(u != v for u, v in pairs)
    found = {r.id: r.component for r in connected_components(links).collect()}
    want = brute_components(list(range(len(values))), values)
    groups, expected = {}, {}
    for v, s, c in zip(values, signed, want):
        expected.setdefault(c, set()).add(s)
        groups.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_paths_stars_and_nothing(frame):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(300, 300), (None, 4), (41, 40), (0, 1)]
    got = {r.id: r.component for r in connected_components(frame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(42)} | {i: 100 for i in range(100, 130)}
    assert connected_components(frame([], "u long, v long")).count() == 0


def test_stage_keeps_one_of_what_the_trie_links(frame):
    """Texts that repeat their lines and differ in the rest: few bits apart, but most of their different shingles are not shared."""
    line = "the same line comes again and again on this very page "
    base = [line * 60, line * 60 + " ".join(f"tail{k}" for k in range(12)), line * 80 + " ".join(f"end{k}" for k in range(15)), "quite another text " * 9]
    # Eleven repeated shingles are far from a tie in every bit, so that the tails turn hardly any.
    marks = [brute_fingerprint(t) for t in base]
    assert max((marks[0] ^ m).bit_count() for m in marks[1:3]) <= 2 < (marks[0] ^ marks[3]).bit_count()
    sets = [set(simhash.jaccard.shingle_set(t).tolist()) for t in base]
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    rows = [(7, base[0]), (4, base[1]), (9, base[2]), (9, base[2].upper()), (5, base[3]), (None, base[1])]
    kept = simhash.keep_one_of_each(frame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(4, base[1]), (5, base[3])]


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([], "doc_id long, text string")).count() == 0
