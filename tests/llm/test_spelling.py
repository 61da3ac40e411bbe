import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stationtide.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = 1 if i is None else zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def brute(rows):
    words = brute_words(rows)
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 2 * words[w]:
                form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def result(docs):
    return sorted(tuple(r) for r in spelling.variants(docs).collect())


def varied(rng, n):
    """Texts whose words are edits of each other, with letters that repeat."""
    letters = "aabbcé×ÿ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(n)]
    for w in list(words):
        for _ in range(4):
            i = rng.randrange(len(w))
            words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + rng.choice(letters) + w[i:]]))
    return [" ".join([w.upper() if rng.random() < 0.1 and w.isascii() else w] * rng.choice([1, 3, 3, 4, 7, 20])) for w in words]


@pytest.mark.parametrize("block, rows_a_slice", [(30_000, 40_000), (20, 50), (7, 100_000)])
def test_equals_brute_force(frame, monkeypatch, block, rows_a_slice):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "SLICE_ROWS", rows_a_slice)
    monkeypatch.setattr(spelling, "SEARCHES", 37)
    rng = random.Random(3)
    rows = list(enumerate(varied(rng, 250)))
    rows += [(9000, None), (9001, ""), (9001, ""), (9002, "aaaaa " * 400 + "aaaaaa " * 100 + "aaaaaaa " * 3), (None, "without anid " * 60), (None, "withoux " * 3),
             (9003, ("z" * 3000 + " ") * 5 + ("z" * 2999 + "y ") * 2 + ("z" * 2999 + "y,") * 2), (9004, "tie1word tieaword " * 5 + "tiebword " * 5 + "tiecword " * 3)]
    rows += [(5, "repeated rows count twice " * 2)] * 3
    rng.shuffle(rows)
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS word", "3 AS n", "4 AS part")
    want = brute(rows)
    assert result(docs) == want and sum(r[4] for r in want) > 400 and any(r[2] not in (r[0], r[1]) for r in want)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_wavelet_and_spans():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 6))) for _ in range(60)]
    codes = spelling.CODE[np.frombuffer("".join(words).encode(), np.uint8)]
    index = spelling.Index(codes, np.array([len(w) for w in words]))
    text = "$" + "$".join(words) + "$"
    for _ in range(200):
        whole = np.array([[0], [0], [index.size]])
        pattern = ""
        for c in rng.choice(list("abc$"), 4):
            right = bool(rng.integers(2))
            pattern = pattern + c if right else c + pattern
            whole = index.grow(whole, np.array([spelling.BREAK if c == "$" else int(spelling.CODE[ord(c)])]), right)
            want = len(re.findall(f"(?={re.escape(pattern)})", text))
            assert whole[2, 0] == want
            if not want:
                break


def test_long_ways_end_at_their_roots(frame):
    chain = frame([(i, i + 1) for i in range(100)] + [(200 + i, 0) for i in range(50)], "id long, form long")
    assert {r.root for r in spelling.roots(chain).collect()} == {100}
    assert spelling.roots(frame([], "id long, form long")).count() == 0


def test_empty_table(frame):
    assert spelling.variants(frame([], "doc_id long, text string")).count() == 0
