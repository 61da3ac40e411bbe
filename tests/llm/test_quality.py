import numpy as np
import pytest

from stationtide.llm import quality


def mixture(rng, n, share, d=6):
    good = rng.random(n) < share
    rows = rng.normal(size=(n, d))
    rows[:, 0] += np.where(good, 2.5, -2.5)
    return rows, good


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85])
def test_prior_and_risk_on_a_known_mixture(share):
    rng = np.random.default_rng(0)
    positive, _ = mixture(rng, 1500, 1.0)
    unlabelled, good = mixture(rng, 3000, share)
    prior = quality.class_prior(positive, unlabelled)
    assert abs(prior - share) < 0.1
    score = quality.fit(positive, unlabelled, prior).score(unlabelled)
    assert np.mean((score >= 0.5) == good) > 0.97
    assert abs(score.mean() - share) < 0.1


def test_features_are_finite_for_any_text():
    for text in (None, "", " ", "\n\n", "a", "\ud800", "é" * 10, "word " * 200_000):
        row = quality.features(text)
        assert row.shape == (quality.WIDTH,) and np.isfinite(row).all()
    assert not quality.features(None).any() and not quality.features("").any()


def test_held_out_labels_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    net = quality.train(docs, labels)
    rows = quality.score_documents(docs, net).join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    assert len(bad) > 50 and (good[:, None] > bad[None, :]).mean() > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean(good >= quality.THRESHOLD) > 0.99


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert all(np.array_equal(x, y) for x, y in zip(a.weights, b.weights))


def test_edge_cases(spark, frame):
    docs = frame([(1, "A clean text."), (1, "A clean text."), (2, None), (3, ""), (None, "x")], "doc_id long, text string").selectExpr("*", "0.5 AS score", "1 AS chosen", "2 AS f")
    labels = frame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    assert quality.train(docs, labels) is None
    got = quality.score_documents(docs, None).collect()
    assert len(got) == 5 and {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    net = quality.train(*tables)
    got = quality.score_documents(docs, net).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and {r.held_out for r in got if r.doc_id is None} == {True}
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert quality.score_documents(docs.limit(0), net).count() == 0
    assert quality.train(docs.limit(0), labels.limit(0)) is None


@pytest.mark.parametrize("prior", [None, 0.05, 0.4, 0.9])
def test_slope_of_the_risk_is_its_derivative(prior):
    rng = np.random.default_rng(2)
    seen = set()
    for shift in (-4.0, 0.0, 4.0):
        z, n, step = rng.normal(shift, 2, 40), 15, 1e-6

        def risk(at):
            if prior is None:
                return (np.logaddexp(0, -at[:n]).mean() + np.logaddexp(0, at[n:]).mean()) / 2
            first, rest = quality.risk_parts(at, n, prior)
            return -rest if below else first + rest

        below = prior is not None and bool(quality.risk_parts(z, n, prior)[1] < 0)
        seen.add(below)
        numeric = [(risk(z + step * (np.arange(40) == k)) - risk(z - step * (np.arange(40) == k))) / 2 / step for k in range(40)]
        assert np.allclose(quality.risk_slope(z, n, prior), numeric, atol=1e-7)
    assert prior != 0.9 or seen == {True, False}


def test_bounds_of_the_sample_are_parameters(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    sizes = []
    monkeypatch.setattr(quality, "class_prior", lambda p, u: sizes.append((len(p), len(u))) or 0.5)
    assert quality.train(docs, labels, 9, 20) is not None and sizes == [(9, 20)]
