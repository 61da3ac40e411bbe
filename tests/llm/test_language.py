import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stationtide.llm import language

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def table():
    return language.pieces(PATH)


def segmentations(data, index):
    if not data:
        return [[]]
    return [[index[data[:n]], *rest] for n in range(1, min(len(data), language.PIECE_BYTES) + 1) if data[:n] in index
            for rest in segmentations(data[n:], index)]


def test_forward_and_counts_equal_the_sum_over_segmentations(table):
    index = {t: i for i, t in enumerate(table.tokens)}
    rng = np.random.default_rng(0)
    chances = np.vstack([rng.dirichlet(np.ones(table.nothing), 3).T, np.zeros(3)])
    words = ["the", "nation", "è", "ab", "zzq", "x", "straße", "日本", "information"]
    model = language.Model(PATH, ["a", "b", "c"], chances)
    got = model.word_scores(words)
    counts = Counter({w: k + 1 for k, w in enumerate(words)})
    used = np.zeros(table.nothing)
    for w, row in zip(words, got):
        ways = segmentations(b" " + w.encode(), index)
        chance = np.array([np.prod(chances[s], axis=0) for s in ways])
        assert np.allclose(row, np.log(chance.sum(axis=0)))
        for s, p in zip(ways, chance[:, 1]):
            np.add.at(used, s, counts[w] * p / chance[:, 1].sum())
    assert np.allclose(language.expected_counts(table, counts, chances[:, 1]), used)


def test_long_words_stay_in_range(table):
    chances = np.append(np.full(table.nothing, 1e-9), 0.0)[:, None]
    model = language.Model(PATH, ["a"], chances)
    one, two = model.word_scores(["qx" * 3000])[0, 0], model.word_scores(["qx" * 1500])[0, 0]
    assert math.isfinite(one) and 1.9 < one / two < 2.1
    both = model.text_scores(["qx" * 3000 + " qx", "qx", None or ""])
    assert np.isclose(both[0, 0], one + both[1, 0]) and both[2, 0] == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs, PATH)
    assert model.languages == ["de", "en", "es", "fr"]
    rows = language.predict_documents(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_edge_cases(frame):
    docs = frame([(1, "the house and the garden " * 20, "en"), (2, "das haus und der garten " * 20, "de"), (3, None, "en"), (4, "x", None), (9, "", "de")] +
                 [(i, "the house is in the garden" if i % 2 else "das haus ist im garten", "en" if i % 2 else "de") for i in range(20, 60)],
                 "doc_id long, text string, lang string")
    model = language.train(docs.selectExpr("*", "'x' AS h", "1 AS r"), PATH)
    test = frame([(1, None), (2, ""), (3, " 12 *** !"), (4, "Das HAUS"), (4, "Das HAUS"), (None, "the house"), (6, "haus " * 100_000)], "doc_id long, text string")
    got = {(r.doc_id, r.lang_pred, r.held_out is True) for r in language.predict_documents(test.selectExpr("*", "'fr' AS lang_pred"), model).collect()}
    assert {(d, p) for d, p, _ in got} == {(1, "und"), (2, "und"), (3, "und"), (4, "de"), (None, "en"), (6, "de")}
    assert (None, "en", True) in got
    assert language.predict_documents(test, model).count() == 7 and language.predict_documents(test.limit(0), model).count() == 0
    nothing = language.train(docs.limit(0), PATH)
    assert {(r.lang_pred, r.score) for r in language.predict_documents(test, nothing).collect()} == {("und", 0.0)}


def test_runs_are_whole_characters():
    for word in ("short", "日本語" * 100, "é" * 31, "x" * 59, "x" * 60, "x" * 61, "🙂" * 500):
        runs = language.runs_of(word)
        assert b"".join(runs) == b" " + word.encode() and all(0 < len(r) <= language.RUN_BYTES for r in runs)
        assert "".join(r.decode() for r in runs) == " " + word


def test_scripts_without_spaces(frame):
    """Texts that are one word each teach as much as any, and are scored in no time."""
    import random
    import time

    rng = random.Random(1)
    kinds = {"ja": "あいうえおかきくけこさしすせそ", "zh": "的一是了我不人在他有这个上们来"}
    text = lambda lang, n: "".join(rng.choice(kinds[lang]) for _ in range(n))
    docs = frame([(i, text(lang, 300), lang) for i, lang in enumerate(["ja", "zh"] * 30)], "doc_id long, text string, lang string")
    model = language.train(docs, PATH)
    assert [model.predict([text(lang, 40)])[0][0] for lang in ("ja", "zh")] == ["ja", "zh"]
    started = time.perf_counter()
    names, _ = model.predict([text("zh", 100_000)])
    assert names == ["zh"] and time.perf_counter() - started < 3


def test_a_language_that_was_not_learned_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 4 = 0")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    for left in ("en", "fr"):
        model = language.train(docs.filter(f"lang <> '{left}'"), PATH, documents=200)
        keep = language.recognised(model, [t for t, _ in rows])
        long = np.array([language.text_bytes(t) >= language.CERTAIN_BYTES for t, _ in rows])
        own = np.array([lang != left for _, lang in rows])
        assert keep[own].mean() > 0.98, (left, keep[own].mean())
        assert keep[~own & long].mean() < 0.1, (left, keep[~own & long].mean())
