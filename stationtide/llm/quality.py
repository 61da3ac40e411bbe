"""Quality classifier from positive and unlabelled texts.

Trusted documents are the positives; all other text is unlabelled, a mixture in which the share of positives (the class
prior) is unknown. A first network tells positives from unlabelled rows; the smallest ratio of the two groups' tails
under its score estimates the prior. A second one minimises the non-negative unbiased risk: the positives' loss
weighted by the prior, plus what the unlabelled rows lose as negatives less the part that the positives among them
explain, a difference that is kept from falling below zero. The logistic loss makes its output a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import held_out, ids_and_texts, keep_rows, written

#: Bounds of the training sample: rows with the first hashes of their ids.
TRAIN_POSITIVES = 4000
TRAIN_UNLABELLED = 8000
HIDDEN = 16
STEPS = 300
RATE = 0.01
DECAY = 1e-3
THRESHOLD = 0.3
#: Bytes whose shares are features: ASCII other than letters, which would tell languages apart rather than quality.
BYTES = np.array([b for b in range(128) if not chr(b).isalpha()])
SHAPES = 14
WIDTH = len(BYTES) + SHAPES


def features(text: str | None) -> np.ndarray:
    """Square roots of the byte shares, and shares that describe words and lines; all zero for an empty text."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(data, minlength=256)
    out[:len(BYTES)] = np.sqrt(count[BYTES] / len(data))
    words, lines = text.split(), text.split("\n")
    if not words:
        return out
    n = len(words)
    often = Counter(words)
    size = np.fromiter(map(len, words), np.int64, n)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    marks = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    out[len(BYTES):] = (
        np.log1p(n), np.log1p(n) ** 2 / 10, len(often) / n, max(often.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, size.mean() / 10, size.std() / 10, (size > 20).mean(),
        upper / max(1, upper + lower), marks / len(data), marks / n / 3, count[48:58].sum() / len(data),
        len(set(lines)) / len(lines), np.log1p(len(data) / len(lines)) / 5,
    )
    return out


@dataclass
class Network:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list

    def logits(self, rows: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.tanh(x @ a + b) @ c + d[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(rows))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_parts(z: np.ndarray, n: int, prior: float) -> tuple[float, float]:
    """Of outputs whose first n are the positives': what these lose as positives, and what is left of the unlabelled rows' loss as
    negatives once the positives among them are taken off. The risk is their sum, with nothing for a negative second part."""
    return prior * np.logaddexp(0, -z[:n]).mean(), np.logaddexp(0, z[n:]).mean() - prior * np.logaddexp(0, z[:n]).mean()


def risk_slope(z: np.ndarray, n: int, prior: float | None) -> np.ndarray:
    """Derivative of the risk by each output. Where the second part is negative it is that part, turned round, which is
    followed: a step back from fitting the rest below nothing. Without a prior, of the two groups' mean loss."""
    p, m = sigmoid(z), len(z) - n
    if prior is None:
        return np.concatenate([(p[:n] - 1) / n / 2, p[n:] / m / 2])
    if risk_parts(z, n, prior)[1] >= 0:
        return np.concatenate([prior * (p[:n] - 1) / n - prior * p[:n] / n, p[n:] / m])
    return np.concatenate([prior * p[:n] / n, -p[n:] / m])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = STEPS) -> Network:
    """Minimise the non-negative risk at the given prior; without a prior, tell the two groups apart."""
    rng = np.random.default_rng(0)
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    x = np.clip((both - mean) / scale, -6, 6)
    n, m, width = len(positive), len(unlabelled), x.shape[1]
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        a, b, c, d = weights
        hidden = np.tanh(x @ a + b)
        slope = risk_slope(np.clip(hidden @ c + d[0], -30, 30), n, prior)
        inner = slope[:, None] * c * (1 - hidden * hidden)
        for k, g in enumerate((x.T @ inner, inner.sum(axis=0), hidden.T @ slope, np.array([slope.sum()]))):
            first, second = moments[k]
            first += 0.1 * (g + DECAY * weights[k] - first)
            second += 0.001 * ((g + DECAY * weights[k]) ** 2 - second)
            weights[k] = weights[k] - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Network(mean, scale, weights)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows: the least ratio of the groups' tails, at the threshold where the
    ratio and its sampling error together are smallest. Each half is scored by a network that has seen the other only."""
    halves: tuple[list, list] = ([], [])
    for k in (0, 1):
        net = fit(positive[k::2], unlabelled[k::2], None, STEPS // 2)
        halves[0].append(net.logits(positive[1 - k::2]))
        halves[1].append(net.logits(unlabelled[1 - k::2]))
    p, u = (np.sort(np.concatenate(half)) for half in halves)
    cuts = np.concatenate([p, u])
    tail_p, tail_u = 1 - np.searchsorted(p, cuts) / len(p), 1 - np.searchsorted(u, cuts) / len(u)
    error = np.sqrt(np.log(40) / 2 / len(p)) + np.sqrt(np.log(40) / 2 / len(u))
    some = tail_p > 0
    ratio = tail_u[some] / tail_p[some]
    best = int((ratio + error / tail_p[some]).argmin())
    return float(np.clip(ratio[best], 0.01, 0.99))


def train(docs: DataFrame, labels: DataFrame, positives: int = TRAIN_POSITIVES, unlabelled_rows: int = TRAIN_UNLABELLED) -> Network | None:
    """Learn from the positives of ``labels`` (doc_id, quality) and from ``docs`` (doc_id, text), both without the rows held
    out: at most ``positives`` and ``unlabelled_rows`` of them, by a hash of their ids. Ids with labels of both kinds are not
    trusted. None when either group has fewer than two rows."""
    trusted = labels.filter("quality IS NOT NULL").filter(~held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    open_docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(~held_out("doc_id"))
    groups = []
    for ids, bound, seed in ((trusted.select("doc_id"), positives, 1), (open_docs.select("doc_id").distinct(), unlabelled_rows, 2)):
        h = F.xxhash64("doc_id", F.lit(seed))
        if seed == 1:
            ids = ids.join(open_docs.select("doc_id"), "doc_id", "left_semi")
        chosen = ids.select("doc_id", h.alias("h")).orderBy("h").limit(bound).select(F.col("doc_id").alias("chosen"))
        rows = open_docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"), "left_semi")
        found = written(rows.mapInArrow(_features, "doc_id long, f array<float>"), "features")
        flat = found.orderBy(F.xxhash64("doc_id", F.lit(seed)), "f").limit(bound).toArrow()["f"].combine_chunks().flatten().to_numpy()
        groups.append(flat.reshape(-1, WIDTH))
    positive, unlabelled = groups
    if min(map(len, groups)) < 2:
        return None
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in ids_and_texts(batch):
            rows = np.array([features(t) for t in texts], np.float32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())], ["doc_id", "f"])


def score_documents(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of each row of ``docs`` (doc_id, text).

    One output row for each input row, repeated rows included; equal texts have equal scores. Null and empty texts are
    scored like any other, by all-zero features. Without a trained network every score is 0.5. A null doc_id stays null
    and counts as held out; an empty table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in ids_and_texts(batch):
                score = np.full(len(texts), 0.5) if net is None else net.score(np.array([features(t) for t in texts], np.float32))
                yield pa.RecordBatch.from_arrays([ids, pa.array(score)], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs`` whose text scores THRESHOLD or more, all columns unchanged; all of them without a network."""
    if net is None:
        return docs
    return keep_rows(docs, lambda texts: net.score(np.array([features(t) for t in texts], np.float32)) >= THRESHOLD)
