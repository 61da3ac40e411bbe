import random

import numpy as np

from stationtide.llm import decontaminate as dc


def semi_global(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def noisy(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdefgh")
        elif kind == 1:
            chars.insert(at, rng.choice("abcdefgh "))
        else:
            del chars[at]
    return "".join(chars)


def word(rng):
    return "".join(rng.choice("abcdefghi") for _ in range(rng.randint(2, 7)))


def test_hashes_depend_on_the_gram_alone():
    codes = dc.code_points("abcdefghijkl abcdefghijkl")
    h = dc.gram_hashes(codes)
    assert len(h) == len(codes) - dc.Q + 1
    assert h[0] == h[13] and len(set(h.tolist())) == len(h) - 3
    assert len(dc.gram_hashes(codes[:dc.Q])) == 1 and len(dc.gram_hashes(codes[:dc.Q - 1])) == 0 and len(dc.gram_hashes(codes[:0])) == 0


def test_every_place_within_the_budget_and_no_other():
    rng = random.Random(3)
    items = [" ".join(word(rng) for _ in range(rng.choice((4, 9, 20, 33)))) for _ in range(25)]
    index = dc.PassageIndex.build(list(enumerate(items)))
    texts = []
    for _ in range(120):
        parts = [" ".join(word(rng) for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items)
            parts.append(noisy(rng, item, rng.randint(0, int(len(item) * 0.11))))
            parts.append(" ".join(word(rng) for _ in range(rng.randint(0, 9))))
        texts.append("  ".join(parts).upper())
    texts += [None, "", items[0], items[0][:-1]]
    found = {(t, p): e for t, p, _, _, e in index.search(texts)}
    want = {}
    for t, text in enumerate(texts):
        for p, codes in enumerate(index.codes):
            edits = semi_global(codes.tolist(), dc.code_points(dc.normal(text)).tolist()) if text else 999
            if edits <= index.edits[p]:
                want[t, p] = edits
    assert found == want
    for t, p, start, end, edits in index.search(texts):
        place = dc.code_points(dc.normal(texts[t]))[start:end].tolist()
        assert semi_global(index.codes[p].tolist(), place) == edits


def test_excerpts_of_the_stated_length_at_every_offset():
    rng = random.Random(9)
    prose = lambda n: " ".join(word(rng) for _ in range(n))
    for words in (22, 28, 33, 60, 130):
        item = prose(words)
        index = dc.PassageIndex.build([(1, item)])
        excerpts = [item[at:at + dc.RUN_CHARS].strip() for at in range(len(item) - dc.RUN_CHARS + 1)]
        texts = [f"{prose(30)} {x} {prose(30)}" for x in excerpts]
        whole = [k for k, x in enumerate(excerpts) if len(x) == dc.RUN_CHARS]
        assert set(whole) <= {t for t, *_ in index.search(texts)}
        assert index.search([f"{prose(30)} {item[at:at + 40]} {prose(30)}" for at in range(0, len(item) - 40, 7)]) == []


def test_short_items_with_an_edit_at_every_place():
    rng = random.Random(12)
    for n in range(dc.Q, 51):
        item = "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
        index = dc.PassageIndex.build([(1, item)])
        texts, most = [item, item], dc.budget(n)
        for at in range(n):
            spots = [(at + k * n // max(1, most)) % n for k in range(most)]  # edits spread evenly, from each place on
            texts.append("".join("#" if k in spots else c for k, c in enumerate(item)))
            texts.append("".join(c for k, c in enumerate(item) if k not in spots))
        texts = [f"{'z' * 30} {t} {'y' * 30}" for t in texts]
        assert {t for t, *_ in index.search(texts)} == set(range(len(texts))), n


def test_the_document_with_the_place_is_named():
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvw"
    for n in range(dc.Q, 45):
        item = "".join(rng.choice(letters) for _ in range(n))
        index = dc.PassageIndex.build([(1, item)])
        texts = ["x" * rng.randrange(60) if rng.random() < 0.7 else None for _ in range(40)]
        hit = sorted(rng.sample(range(40), 9))
        for t in hit:
            kind, more = rng.randrange(3), "y" * rng.randrange(40)
            texts[t] = (item + " " + more, more + " " + item, item)[kind]
        assert [(t, e) for t, _, _, _, e in index.search(texts)] == [(t, 0) for t in hit], n


def test_parts_of_items_are_found():
    rng = random.Random(10)
    for _ in range(20):
        item = " ".join(word(rng) for _ in range(32))[:170]
        for share in (0.9, 0.85, 0.75):
            n = int(len(item) * share)
            at = rng.randrange(len(item) - n)
            text = " ".join(word(rng) for _ in range(20)) + item[at:at + n] + " ".join(word(rng) for _ in range(20))
            assert dc.PassageIndex.build([(1, item)]).search([text])


def test_windows_of_long_texts_give_the_same_places(monkeypatch):
    rng = random.Random(6)
    items = [" ".join(word(rng) for _ in range(40)) for _ in range(12)]
    index = dc.PassageIndex.build(list(enumerate(items)))
    texts = [" ".join(noisy(rng, rng.choice(items), rng.randint(0, 12)) if rng.random() < 0.2 else word(rng) for _ in range(n)) for n in (900, 0, 3, 1500)]
    whole = index.search(texts)
    monkeypatch.setattr(dc, "WINDOW_CHARS", 1000)
    assert len(whole) > 10 and index.search(texts) == whole


def test_rows_and_edge_cases(frame):
    rng = random.Random(4)
    item = " ".join(word(rng) for _ in range(60))
    clean = " ".join(word(rng) for _ in range(5000))
    docs = frame([(1, clean), (2, clean + " " + item), (2, clean + " " + item), (3, None), (4, ""), (None, item.upper()), (5, item[-210:]), (6, item[:90])],
                 "doc_id long, text string").selectExpr("*", "7 AS item_id", "'x' AS edits")
    bench = frame([(1, item), (1, item), (2, None), (3, "short"), (None, clean)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.edits) for r in dc.contaminated(docs, bench).collect())
    assert got == [(0, 1, 0), (2, 1, 0), (2, 1, 0), (5, 1, 0), (6, 1, 0)]
    assert dc.contaminated(docs.limit(0), bench).count() == 0
    assert dc.contaminated(docs, bench.limit(0)).count() == 0


def test_blocks_give_the_same_rows(frame, monkeypatch):
    rng = random.Random(8)
    items = [" ".join(word(rng) for _ in range(20)) for _ in range(12)]
    docs = frame([(i, noisy(rng, " ".join(rng.sample(items, 2)), 6)) for i in range(20)], "doc_id long, text string")
    bench = frame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, dc.contaminated(docs, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    assert whole and sorted(map(tuple, dc.contaminated(docs, bench).collect())) == whole


def test_planted_items_in_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, dc.normal(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in dc.normal(r.text)}
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).filter("edits = 0").collect()}
    assert want and want <= got
