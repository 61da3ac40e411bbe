"""Language of a text under unigram models of vocabulary pieces, summed over all segmentations.

A fixed public byte-level vocabulary gives the pieces. For each language, expectation-maximisation fits their
probabilities to a bounded sample of labelled documents: the forward-backward algorithm spreads every word over all of
its segmentations. A text is scored by the forward algorithm alone: the probability of a word is the sum over its
segmentations, that of a text the product over its words. Words are aligned in arrays by length, so one step of the
recursion serves all of them and all languages. A word of more than RUN_BYTES, as in scripts without spaces, is cut into
runs that are scored and learned side by side, whatever its length.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from stationtide.llm.common import held_out, ids_and_texts, keep_rows, written

#: Longest piece of the vocabulary that is used, in bytes; every single byte is a piece.
PIECE_BYTES = 16
#: Bound of the training sample: documents of each language, the first by a hash of id and text. Up to a thousand, Spark
#: cuts the ranking short before the shuffle.
TRAIN_DOCUMENTS = 1000
#: Longer words are cut, between characters, into runs of so many bytes at most.
RUN_BYTES = 60
#: Of the training documents, by their mean log probability of a byte: a text that lies below this share of them by more than
#: SLACK times their spread is in no learned language. Texts of fewer bytes than CERTAIN_BYTES are not judged by it.
FLOOR_SHARE = 0.02
SLACK = 2.0
CERTAIN_BYTES = 200
ROUNDS = 3
SMOOTHING = 0.1
UNKNOWN = "und"
#: Words after which a worker forgets what it has scored; only a bound on memory.
MEMO_WORDS = 200_000
TABLE_BITS = 20
BASE = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)
LETTER = regex.compile(r"\p{L}")


def words_of(text: str) -> list[str]:
    return text.lower().split()


def runs_of(word: str) -> list[bytes]:
    """The word with a blank before it, in runs of RUN_BYTES at most that end between characters."""
    data, out = b" " + word.encode("utf-8", "surrogatepass"), []
    while len(data) > RUN_BYTES:
        end = RUN_BYTES
        while data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[:end])
        data = data[end:]
    return [*out, data]


class Pieces:
    """Hash table from byte strings to piece numbers, read for whole arrays at once."""

    def __init__(self, path: str):
        with open(path, "rb") as source:
            tokens = [base64.b64decode(line.split()[0]) for line in source if line.strip()]
        self.tokens = [t for t in tokens if 0 < len(t) <= PIECE_BYTES]
        assert len({t for t in self.tokens if len(t) == 1}) == 256
        hashes = np.zeros(len(self.tokens), np.uint64)
        for k, token in enumerate(self.tokens):
            h = 0
            for byte in token:
                h = (h * int(BASE) + byte + 1) & (1 << 64) - 1
            hashes[k] = h
        slots = self._slot(hashes)
        order = np.argsort(slots, kind="stable")
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)
        self.first = np.searchsorted(slots[order], np.arange((1 << TABLE_BITS) + 1)).astype(np.int32)
        self.chain = int(np.diff(self.first).max())
        self.hashes = np.append(self.hashes, np.zeros(self.chain, np.uint64))
        self.nothing = len(self.tokens)

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * MIX) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number of each hash, or ``nothing``."""
        flat = hashes.ravel()
        out = np.full(len(flat), self.nothing, np.int32)
        slot = self._slot(flat)
        first = self.first[slot]
        some = np.flatnonzero(self.first[slot + 1] > first)
        at, want = first[some], flat[some]
        for step in range(self.chain):
            hit = self.hashes[at + step] == want
            out[some[hit]] = self.numbers[at[hit] + step]
        return out.reshape(hashes.shape)

    def spans(self, data: np.ndarray) -> list[np.ndarray]:
        """For each length l from 1 on, the piece at [s, s + l) of each row and start s."""
        wide = data.astype(np.uint64) + np.uint64(1)
        h, out = wide, []
        for size in range(1, min(PIECE_BYTES, data.shape[1]) + 1):
            if size > 1:
                h = h[:, :-1] * BASE + wide[:, size - 1:]
            out.append(np.ascontiguousarray(self.find(h).T))
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def aligned(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in ``words``, zero-padded bytes, lengths) of groups of words of similar length and bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        shortest = int(lengths[order[at]])
        rows = max(1, 1_500_000 // (shortest * PIECE_BYTES))
        most = shortest if shortest < 24 else shortest + shortest // 4
        end = min(at + rows, int(np.searchsorted(lengths[order], most, "right")))
        own = order[at:end]
        size = lengths[own]
        wide = int(size.max())
        data = np.frombuffer(b"".join(words[i].ljust(wide, b"\0") for i in own.tolist()), np.uint8).reshape(len(own), wide)
        yield own, data, size
        at = end


def forward(spans: list[np.ndarray], size: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Log probability of each row, for each language, summed over all segmentations."""
    n, k, wide = len(size), chances.shape[1], int(size.max())
    alpha = np.zeros((wide + 1, n, k))
    alpha[0] = 1
    scale = np.zeros((n, k))
    out = np.zeros((n, k))
    for end in range(1, wide + 1):
        total = alpha[end]
        for length in range(1, min(PIECE_BYTES, end) + 1):
            total += alpha[end - length] * chances[spans[length - 1][end - length]]
        if end % 8 == 0:  # before the products run out of range
            top = total.copy()
            alpha[max(0, end - PIECE_BYTES + 1):end + 1] /= top
            scale += np.log(top)
        done = size == end
        if done.any():
            out[done] = np.log(alpha[end][done]) + scale[done]
    return out


def expected_counts(table: Pieces, words: Counter, chances: np.ndarray) -> np.ndarray:
    """How often each piece is used, over all segmentations of all words under one language's probabilities."""
    out = np.zeros(table.nothing + 1)
    chances = chances.ravel()
    items = [(run, n) for w, n in words.items() for run in runs_of(w)]
    times = np.array([n for _, n in items], float)
    for own, data, size in aligned([w for w, _ in items]):
        spans, wide = table.spans(data), data.shape[1]
        alpha, beta = np.zeros((wide + 1, len(own))), np.zeros((wide + 1, len(own)))
        alpha[0] = 1
        beta[size, np.arange(len(own))] = 1
        for end in range(1, wide + 1):
            for length in range(1, min(PIECE_BYTES, end) + 1):
                alpha[end] += alpha[end - length] * chances[spans[length - 1][end - length]]
        for start in range(wide - 1, -1, -1):
            for length in range(1, min(PIECE_BYTES, wide - start) + 1):
                beta[start] += beta[start + length] * chances[spans[length - 1][start]]
        weight = np.divide(times[own], beta[0], out=np.zeros(len(own)), where=beta[0] > 0)
        for length, found in enumerate(spans, 1):
            share = alpha[:wide - length + 1] * beta[length:] * chances[found] * weight
            out += np.bincount(found.ravel(), share.ravel(), minlength=len(out))
    return out[:-1]


class Model:
    """Piece probabilities of each language, and the mean log probability of a byte below which a text is in none of them."""

    def __init__(self, path: str, languages: list[str], chances: np.ndarray, floors: np.ndarray | None = None):
        self.path, self.languages, self.chances = path, languages, chances
        self.floors = np.full(len(languages), -np.inf) if floors is None else floors
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((0, len(languages)))

    def __getstate__(self):
        return vars(self) | {"memo": {}, "rows": np.zeros((0, len(self.languages)))}

    def word_scores(self, words: list[str]) -> np.ndarray:
        table = pieces(self.path)
        runs = [runs_of(w) for w in words]
        counts = np.fromiter(map(len, runs), np.int64, len(runs))
        scores = np.zeros((int(counts.sum()), len(self.languages)))
        for own, block, size in aligned([run for each in runs for run in each]):
            scores[own] = forward(table.spans(block), size, self.chances)
        return np.add.reduceat(scores, np.cumsum(counts) - counts, axis=0) if len(runs) else scores

    def text_scores(self, texts: list[str]) -> np.ndarray:
        """Log probability of each text, for each language."""
        split = [words_of(t) for t in texts]
        memo = self.memo
        new = list(dict.fromkeys(w for words in split for w in words if w not in memo))
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            self.rows = self.rows[:0]
            new = list(dict.fromkeys(w for words in split for w in words))
        memo.update(zip(new, range(len(memo), len(memo) + len(new))))
        self.rows = np.concatenate([self.rows, self.word_scores(new)])
        out = np.zeros((len(texts), len(self.languages)))
        for i, words in enumerate(split):
            if words:
                out[i] = self.rows[np.fromiter(map(memo.__getitem__, words), np.int64, len(words))].sum(axis=0)
        return out

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts with a letter: their places, the number of the most probable language, its posterior under equal
        priors, and the text's log probability under it."""
        known = np.array([i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.languages else [], np.int64)
        logs = self.text_scores([texts[i] for i in known.tolist()])
        if not len(known):
            return known, known, np.zeros(0), np.zeros(0)
        best = logs.argmax(axis=1)
        top = logs.max(axis=1)
        return known, best, 1 / np.exp(logs - top[:, None]).sum(axis=1), top

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior; ``und`` and 0 without a letter."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known, best, posterior, _ = self.judge(texts)
        scores[known] = posterior
        for i, b in zip(known.tolist(), best.tolist()):
            names[i] = self.languages[b]
        return names, scores


def text_bytes(text: str | None) -> int:
    """Bytes that are scored: those of the words, and a blank for each."""
    words = words_of(text or "")
    return len(" ".join(words).encode("utf-8", "surrogatepass")) + 1 if words else 0


def train(docs: DataFrame, path: str, documents: int = TRAIN_DOCUMENTS) -> Model:
    """Fit to the labelled rows of ``docs`` (doc_id, text, lang) that are not held out, at most ``documents`` of each language;
    rows without text or language teach nothing. Equal ids and texts are interchangeable."""
    labelled = docs.filter("lang IS NOT NULL AND length(text) > 0").filter(~held_out("doc_id")).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    first = _first_hashes(_first_hashes(labelled.select("lang", "h"), documents, "lang", F.pmod("h", F.lit(256))), documents, "lang")
    # As many hashes as languages times the bound; rows that repeat id and text count once.
    rows = labelled.join(F.broadcast(first.select("h").distinct()), "h", "left_semi").dropDuplicates(["lang", "h"])
    sample = written(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism, "h").select("lang", "text"), "languages")
    languages = [r.lang for r in sample.select("lang").distinct().orderBy("lang").collect()]
    table = pieces(path)
    chances = np.full((table.nothing + 1, len(languages)), 1 / table.nothing)
    for _ in range(ROUNDS):
        chances[-1] = 0
        counts = sample.mapInArrow(_expect(path, languages, chances), "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        chances = np.full((table.nothing + 1, len(languages)), SMOOTHING)
        chances[counts["piece"].to_numpy(), counts["lang"].to_numpy()] += counts["n"].to_numpy()
        chances[-1] = 0
        chances /= chances.sum(axis=0)
    model = Model(path, languages, chances)
    # The sample is bounded, so these are as many figures as documents at most.
    fits = sample.mapInArrow(_fits(model), "lang string, fit double").groupBy("lang").agg(F.percentile("fit", F.lit(FLOOR_SHARE)).alias("low"), F.stddev_pop("fit").alias("spread"))
    for row in fits.collect():
        model.floors[languages.index(row.lang)] = row.low - SLACK * row.spread
    return model


def _fits(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, texts in ids_and_texts(batch, "lang", max_chars=1_000_000):
                own = [(lang, t, n) for lang, t, n in zip(langs.to_pylist(), texts, map(text_bytes, texts)) if n >= CERTAIN_BYTES]
                logs = model.text_scores([t for _, t, _ in own])
                fit = [logs[k, model.languages.index(lang)] / n for k, (lang, _, n) in enumerate(own)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in own], pa.string()), pa.array(fit, pa.float64())], ["lang", "fit"])

    return run


def _first_hashes(rows: DataFrame, most: int, *group) -> DataFrame:
    """The ``most`` smallest values of ``h`` in each group; no text is ranked or shuffled."""
    by = Window.partitionBy(*group).orderBy("h")
    return rows.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= most).select("lang", "h")


def _expect(path: str, languages: list[str], chances: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in words.items():
                k = languages.index(lang)
                n = expected_counts(table, counter, chances[:, k])
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used])], ["lang", "piece", "n"])
            words.clear()

        for batch in batches:
            for langs, texts in ids_and_texts(batch, "lang"):
                for lang, text in zip(langs.to_pylist(), texts):
                    words.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, words.values())) > MEMO_WORDS:
                    yield from flush()
        yield from flush()

    return run


def predict_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of each row of ``docs`` (doc_id, text).

    One output row for each input row, repeated rows included. A text that is null, empty or without a letter, and every
    text where nothing was learned, is ``und`` with score 0. At equal scores the language that sorts first is taken. A
    null doc_id stays null and counts as held out; an empty table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=1_000_000):
                names, scores = model.predict(texts)
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def recognised(model: Model, texts: list[str | None], least: float = 0.5) -> np.ndarray:
    """Which texts are in a learned language: its posterior among the learned ones is ``least`` or more, and the text is not less
    probable under it, by the byte, than nearly all of the documents that taught it. Where nothing was learned, all with a letter."""
    if not model.languages:
        return np.array([bool(t and LETTER.search(t)) for t in texts], bool)
    known, best, posterior, top = model.judge(texts)
    sizes = np.array([text_bytes(texts[i]) for i in known.tolist()], np.int64)
    like = (sizes < CERTAIN_BYTES) | (top >= model.floors[best] * sizes)
    out = np.zeros(len(texts), bool)
    out[known] = (posterior >= least) & like
    return out


def keep_recognised(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is :func:`recognised`, all columns unchanged."""
    return keep_rows(docs, lambda texts: recognised(model, texts, least))
