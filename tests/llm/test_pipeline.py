import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stationtide.llm import decontaminate, language, quality, simhash
from test_jaccard import brute_kept

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before the first and after each stage, written and read again in between."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*(sorted(map(tuple, d.select(*COLUMNS).collect())) for d in out), docs.collect()]


def test_columns_stay(spark, steps):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER).columns == COLUMNS


def test_quality_and_language_keep_what_their_scores_say(spark, steps):
    raw = spark.read.parquet(f"{FOLDER}/documents.parquet")
    net = quality.train(raw, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = [r for r in steps[0] if net.score(quality.features(r[1])[None])[0] >= quality.THRESHOLD]
    assert steps[1] == good and 0.7 < len(good) / len(steps[0]) < 1
    model = language.train(spark.createDataFrame(good, "doc_id long, text string, lang string, source string, n_chars long"), corpus_pipeline.PIECE_VOCABULARY)
    names, scores = model.predict([r[1] for r in good])
    like = language.recognised(model, [r[1] for r in good], 0)
    assert steps[2] == [r for r, n, s, f in zip(good, names, scores, like) if n != "und" and s >= 0.5 and f] and len(steps[2]) > 0.97 * len(good)


def test_one_document_of_each_group_stays(steps):
    before = steps[2]
    kept, links = brute_kept([(r[0], r[1]) for r in before])
    assert steps[3] == [r for r in before if r[0] in set(kept)] and links and len(steps[3]) < len(before)


def test_benchmark_passages_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {r[0] for r in steps[3] for _, t in items if decontaminate.normal(t) in decontaminate.normal(r[1])}
    index = decontaminate.PassageIndex.build(sorted(items))
    found = {steps[3][t][0] for t, *_ in index.search([r[1] for r in steps[3]])}
    assert leaks and leaks <= found and steps[4] == [r for r in steps[3] if r[0] not in found] and len(found) < 0.1 * len(steps[3])


def test_the_rest_is_encoded(spark, steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict((r[0], r[1]) for r in steps[4])
    assert sorted(r.doc_id for r in steps[5]) == sorted(texts)
    for r in steps[5]:
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) and r.decoded == texts[r.doc_id]
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, steps[5]))


def test_one_of_each_with_odd_rows(frame):
    a, b, c = "some words that are here " * 9, "quite another text stands there " * 9, "third thing of its own kind now " * 9
    rows = [(5, a), (5, a), (3, a), (5, b), (5, b), (9, b), (None, a), (None, c), (None, c), (7, None), (8, "")]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS least", "'x' AS c")
    got = simhash.keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, a), (5, b), (None, c), (7, None)], key=str)


def test_every_stage_takes_odd_and_empty_tables(spark, frame):
    docs = frame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 50_000, None, None, 1)],
                 "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS score", "2 AS fp", "'x' AS ids", "3 AS `my col`", "4 AS `a.b`")
    for part in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, part, FOLDER)
            assert name == "encoding" or out.columns == docs.columns
            assert out.count() <= part.count()
    assert np.isfinite(corpus_pipeline.encoded(spark, docs, FOLDER).agg({"n_tokens": "sum"}).first()[0])
