"""Spelling variants of the words of a corpus, found in bidirectional FM-indexes of the delimited vocabulary.

Of two words that differ by one edit, the shorter having m letters, either the first m // 2 letters are equal or the last
m - m // 2. Words meet in buckets of these halves; Spark deals the buckets out, so that an index holds some ten thousand
words and neither a task nor the driver sees the vocabulary. A bucket of many words is dealt out as pairs of blocks, one
to be indexed and one to be searched.

In a task the words of some buckets stand one after the other between delimiters. Two rank structures, over the
Burrows-Wheeler transforms of this text and of its reverse, keep a pair of suffix intervals in step while a pattern
grows to either side. A search begins with the interval of a whole half and its delimiter, goes on across the other half
letter by letter, leaves the word once (a letter replaced, inserted or left out), and ends at the other delimiter. Only
counts and the best near word of each search leave the task, never the pairs.

The count of words is a partial aggregate; forms are followed to their roots by doubling, a join for each round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import written
from stationtide.llm.merkle import placed
from stationtide.llm.oracles import crc32_sql, crc_table_sql

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: One of so many occurrences loses a letter, as a slip of the pen would do.
SLIP = 97
#: Words of a bucket that one index takes; larger buckets are dealt out as pairs of blocks.
BLOCK_WORDS = 30_000
#: Rows after which a task builds an index, at the next end of a bucket.
SLICE_ROWS = 40_000
#: Searches that go on side by side.
SEARCHES = 20_000
#: Symbols: 0 ends the text, 1 parts words, then the letters of the class, a to z and U+00C0 to U+00FF.
END, BREAK, BITS = 0, 1, 7
CODE = np.zeros(256, np.uint8)
CODE[97:123] = np.arange(2, 28)
CODE[0xC0:0x100] = np.arange(28, 92)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of ``docs`` (doc_id, text): runs of letters in lower case, one of SLIP occurrences with a letter lost.

    Null texts have no words. A row without doc_id loses no letters.
    """
    low = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.concat(F.col("doc_id").cast("long").cast("string"), F.lit(":")).alias("head"), F.explode(F.regexp_extract_all(low, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    hashed = runs.filter(F.length("run") >= LEAST_LETTERS).withColumn("h", F.crc32(F.concat("head", "run").cast("binary")))
    at = F.expr("CAST(h % length(run) AS INT)")
    word = F.when(F.col("h") % SLIP == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def buckets(words: DataFrame) -> DataFrame:
    """``id``, ``word``, ``n``, ``m``, ``side``, ``part`` and whether the row is to be an ``entry`` and a ``search`` there, for ``words`` (id, word, n)."""
    both = words.select("id", "word", "n", F.length("word").alias("size")).withColumn("m", F.explode(F.array("size", F.col("size") - 1))).filter(F.col("m") >= LEAST_LETTERS)
    half = F.expr("m DIV 2").cast("int")
    keyed = both.select("id", "word", "n", "m", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")),
        F.struct(F.lit(1).alias("side"), F.substring("word", F.col("size") - F.col("m") + half + 1, F.col("m") - half).alias("half")))).alias("k")).select("id", "word", "n", "m", "k.*")
    sizes = keyed.groupBy("side", "m", "half").agg(F.ceil(F.count("*") / BLOCK_WORDS).alias("blocks"), F.count("*").alias("c")).filter("c > 1").drop("c")
    dealt = keyed.join(sizes, ["side", "m", "half"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = lambda i, j, entry, search: F.struct(F.col(i).alias("i"), F.col(j).alias("j"), F.lit(entry).alias("entry"), F.lit(search).alias("search"))
    own = F.array(pair("own", "own", True, True))
    apart = F.array(pair("own", "other", True, False), pair("other", "own", False, True))
    spread = other.withColumn("p", F.explode(F.when(F.col("own") == F.col("other"), own).otherwise(apart)))
    return spread.select("id", "word", "n", "m", "side", F.concat_ws("/", "side", "m", "half", "p.i", "p.j").alias("part"), "p.entry", "p.search")


class Wavelet:
    """Symbols of a sequence by their bits, highest first: rank, and the number of smaller symbols, in any range."""

    def __init__(self, symbols: np.ndarray):
        self.ones, self.zeros = [], []
        for shift in range(BITS - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.first = np.zeros(1 << BITS, np.int64)
        present, at = np.unique(symbols, return_index=True)
        self.first[present] = at

    def follow(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of symbol c[k]: how often before lo[k], how often in lo[k]:hi[k]; and how many smaller ones are in it."""
        smaller = np.zeros(len(lo), np.int64)
        for level in range(BITS):
            bit = (c >> (BITS - 1 - level)) & 1 == 1
            a, b = self.ones[level][lo], self.ones[level][hi]
            smaller += np.where(bit, (hi - lo) - (b - a), 0)
            lo, hi = np.where(bit, self.zeros[level] + a, lo - a), np.where(bit, self.zeros[level] + b, hi - b)
        return lo - self.first[c], hi - lo, smaller

    def every(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """``follow`` for all symbols that stand in the ranges: (range, symbol, before, count, smaller)."""
        k, c, smaller = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for level in range(BITS):
            a, b = self.ones[level][lo], self.ones[level][hi]
            none = (hi - lo) - (b - a)
            left, right = none > 0, b > a
            k = np.concatenate([k[left], k[right]])
            c = np.concatenate([2 * c[left], 2 * c[right] + 1])
            smaller = np.concatenate([smaller[left], smaller[right] + none[right]])
            z = self.zeros[level]
            lo, hi = np.concatenate([(lo - a)[left], z + a[right]]), np.concatenate([(hi - b)[left], z + b[right]])
        return k, c, lo - self.first[c], hi - lo, smaller


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Places of the suffixes of ``text`` in the order of their first ``longest`` symbols at least."""
    n = len(text)
    rank, seen = np.zeros(n, np.int64), 8
    for k in range(seen):
        rank <<= BITS
        rank[:n - k] += text[k:]
    while True:
        order = np.argsort(rank, kind="stable")
        own = rank[order]
        rank[order] = np.concatenate(([0], np.cumsum(own[1:] != own[:-1])))
        if seen >= longest or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:n - seen] = rank[seen:] + 1
        rank = rank * (n + 2) + after
        seen *= 2


class Index:
    """Bidirectional FM-index of words, given as their codes one after the other and their lengths."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        n = len(sizes)
        text = np.full(len(codes) + n + 2, BREAK, np.int64)
        starts = np.cumsum(np.concatenate(([0], sizes[:-1] + 1)))  # of the delimiters before the words
        at = np.ones(len(text), bool)
        at[starts] = at[-1] = at[-2] = False
        text[at] = codes
        text[-1] = END
        longest = int(sizes.max(initial=0)) + 2
        order = suffix_order(text, longest)
        back = np.concatenate([text[-2::-1], [END]])
        self.size = len(text)
        self.left = Wavelet(text[order - 1])
        self.right = Wavelet(back[suffix_order(back, longest) - 1])
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << BITS))))
        entry = np.full(len(text), -1, np.int64)
        entry[starts] = np.arange(n)
        self.entries = entry[order]

    def grow(self, spans: np.ndarray, c: np.ndarray, right: bool) -> np.ndarray:
        """Spans (rows: start in the order of the text, start in that of its reverse, size) of the patterns with c at one end."""
        near, far = (1, 0) if right else (0, 1)
        before, count, smaller = (self.right if right else self.left).follow(c, spans[near], spans[near] + spans[2])
        out = np.empty_like(spans)
        out[near], out[far], out[2] = self.before[c] + before, spans[far] + smaller, count
        return out

    def branch(self, spans: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which span, symbol, span with it) for every symbol that occurs next to the patterns."""
        near, far = (1, 0) if right else (0, 1)
        k, c, before, count, smaller = (self.right if right else self.left).every(spans[near], spans[near] + spans[2])
        out = np.empty((3, len(k)), np.int64)
        out[near], out[far], out[2] = self.before[c] + before, spans[far][k] + smaller, count
        return k, c, out

    def search(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, m: np.ndarray, right: bool, lone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(search, entry) of all words one edit away from the given ones, the shorter of the two having m letters, and with
        one half of m equal: the first one where the search goes on to the ``right``, the last one otherwise. ``lone``: whether
        the word itself is an entry, so that a span of one holds nothing else."""
        half = m // 2 if right else m - m // 2
        longer = sizes > m
        # The first half is matched from its end to the delimiter before it, the last one from the delimiter after it.
        spans = np.stack([np.zeros(len(m), np.int64), np.zeros(len(m), np.int64), np.full(len(m), self.size)])
        base = starts + np.where(right, half, sizes) - 1
        edge = np.full(len(m), BREAK)
        if not right:
            spans = self.grow(spans, edge, False)
        for k in range(int(half.max(initial=0))):
            on = np.flatnonzero((k < half) & (spans[2] > 0))
            spans[:, on] = self.grow(spans[:, on], codes[base[on] - k].astype(np.int64), False)
        if right:
            spans = self.grow(spans, edge, False)
        step = 1 if right else -1
        first = starts + np.where(right, half, sizes - half - 1)
        last = sizes - half  # letters still to come
        q, done = np.arange(len(m)), np.zeros(len(m), np.int64)
        edited = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((3, 0), np.int64))
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q) or len(edited[0]):
            # Words that have left their own: only their own letters follow, then the delimiter.
            eq, ed, es = edited
            over = ed == last[eq]
            letter = np.where(over, BREAK, codes[np.where(over, 0, first[eq] + step * ed)])
            es = self.grow(es, letter.astype(np.int64), right)
            full = es[2] > 0
            end = full & over
            if end.any():
                count = es[2, end]
                rows = np.repeat(es[0, end] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                hits.append((np.repeat(eq[end], count), self.entries[rows]))
            go = full & ~over
            more = [(eq[go], ed[go] + 1, es[:, go])]
            # Words that are still their own.
            keep = (spans[2] > 1) | ((spans[2] > 0) & ~lone[q])
            q, done, spans = q[keep], done[keep], spans[:, keep]
            over = done == last[q]
            here = np.where(over, -1, codes[np.where(over, 0, first[q] + step * done)].astype(np.int64))
            k, c, grown = self.branch(spans, right)
            letters = (c > BREAK) & (c != here[k])
            insert = letters & ~longer[q[k]]
            replace = insert & ~over[k]
            more += [(q[k[insert]], done[k[insert]], grown[:, insert]), (q[k[replace]], done[k[replace]] + 1, grown[:, replace])]
            # Of equal letters in a row the last one is left out.
            after = np.where(done + 1 >= last[q], -1, codes[np.where(done + 1 >= last[q], 0, first[q] + step * (done + 1))].astype(np.int64))
            without = longer[q] & ~over & (after != here)
            more.append((q[without], done[without] + 1, spans[:, without]))
            edited = tuple(np.concatenate([x[i] for x in more], axis=-1) for i in range(3))
            same = c == here[k]
            q, done, spans = q[k[same]], done[k[same]] + 1, grown[:, same]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def near_words(rows: pa.Table, searches: int) -> pa.RecordBatch:
    """``id``, ``n_near``, ``best_n``, ``best`` (id) of the searches in whole parts of ``buckets`` that have a near word there."""
    words = rows["word"].to_pylist()
    codes = CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    part = rows["part"].combine_chunks().dictionary_encode().indices.to_numpy()
    ids, n, m, side = (rows[c].to_numpy().astype(np.int64) for c in ("id", "n", "m", "side"))
    entry, search = (rows[c].to_numpy() for c in ("entry", "search"))
    entries = np.flatnonzero(entry)
    taken = np.repeat(entry, sizes)
    index = Index(codes[taken], sizes[entries])
    found_q, found_e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for which in (0, 1):
        queries = np.flatnonzero(search & (side == which))
        for at in range(0, len(queries), searches):
            some = queries[at:at + searches]
            q, e = index.search(codes, starts[some], sizes[some], m[some], which == 0, entry[some])
            q, e = some[q], entries[e]
            met = part[q] == part[e]
            q, e = q[met], e[met]
            if which:  # pairs with equal first halves are found there
                half = m[q] // 2
                equal = np.ones(len(q), bool)
                for k in range(int(half.max(initial=0))):
                    on = np.flatnonzero(equal & (k < half))
                    if not len(on):
                        break
                    equal[on] = codes[starts[q[on]] + k] == codes[starts[e[on]] + k]
                q, e = q[~equal], e[~equal]
            found_q.append(q)
            found_e.append(e)
    q, e = np.concatenate(found_q), np.concatenate(found_e)
    order = np.lexsort((ids[e], -n[e], q))
    q, e = q[order], e[order]
    heads = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    count = np.diff(np.append(heads, len(q)))
    return pa.RecordBatch.from_arrays([pa.array(ids[q[heads]]), pa.array(count), pa.array(n[e[heads]]), pa.array(ids[e[heads]])], ["id", "n_near", "best_n", "best"])


def _search_parts(slice_rows: int, searches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
            if sum(b.num_rows for b in kept) >= slice_rows:
                rows = pa.Table.from_batches(kept)
                last = pc.index(rows["part"], rows["part"][-1]).as_py()  # sorted: the last part may go on in the next batch
                if last:
                    yield near_words(rows.slice(0, last), searches)
                kept = rows.slice(last).combine_chunks().to_batches()
        if kept:
            yield near_words(pa.Table.from_batches(kept), searches)

    return run


def roots(forms: DataFrame) -> DataFrame:
    """``id``, ``root`` of each row of ``forms`` (id, form): the end of the way from form to form, which has no circles."""
    way = written(forms.select("id", F.col("form").alias("root")), "way")
    while True:
        after = way.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        joined = written(way.join(after, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "way")
        way = joined.select("id", "root")
        if joined.filter("_moved").isEmpty():
            return way


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of each word of ``docs`` (doc_id, text).

    A word has LEAST_LETTERS letters and LEAST_COUNT occurrences at least. Its form is the most frequent of the words
    that are one inserted, deleted or replaced letter away, of equally frequent ones the first in code-point order, if that is at
    least twice as frequent as itself; its root is the end of the way from form to form, or the word itself. Repeated rows
    count again; null, empty and very long texts are texts like any other; an empty table gives an empty result, and other
    columns are not read.
    """
    ranked = placed(written(word_counts(docs), "words"), ["word"], "words").withColumnRenamed("place", "id")
    words = written(ranked.select("id", "word", "n"), "words")
    parts = buckets(words).repartition("part").sortWithinPartitions("part")
    found = parts.mapInArrow(_search_parts(SLICE_ROWS, SEARCHES), "id long, n_near long, best_n long, best long")
    best = found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max(F.struct("best_n", (-F.col("best")).alias("best"))).alias("b")).select("id", "n_near", "b.best_n", (-F.col("b.best")).alias("best"))
    near = written(best, "near")
    every = words.join(near, "id", "left").withColumn("form", F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best")))
    ways = roots(every.filter("form IS NOT NULL").select("id", "form"))
    named = lambda key, name: words.select(F.col("id").alias(key), F.col("word").alias(name))
    full = every.withColumnRenamed("form", "_form").join(ways.withColumnRenamed("root", "_root"), "id", "left")
    full = full.join(named("_form", "form"), "_form", "left").join(named("_root", "root"), "_root", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(F.col("_form").isNotNull(), F.col("best_n")).alias("form_n"))


def oracle_sql() -> str:
    """The same by joins on words with a letter left out."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE crc AS ({crc_table_sql()}),
runs AS (SELECT doc_id, unnest(regexp_extract_all({low}, '[a-zÀ-ÿ]+')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
hashed AS (SELECT run, c, {crc32_sql("doc_id || ':' || run")} AS h FROM each, crc),
slipped AS (SELECT CASE WHEN h % {SLIP} = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word, c FROM hashed),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT a, count(*) AS n_near, arg_max(b, (n, -rk)) AS b, max(n) AS b_n FROM (SELECT *, row_number() OVER (ORDER BY b) AS rk FROM pairs) GROUP BY a),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 2 * n THEN b END AS form, CASE WHEN b_n >= 2 * n THEN b_n END AS form_n FROM words w LEFT JOIN best ON a = word),
way(word, place) AS (SELECT word, word FROM forms UNION ALL SELECT y.word, f.form FROM way y JOIN forms f ON f.word = y.place WHERE f.form IS NOT NULL),
ends AS (SELECT y.word, y.place AS root FROM way y JOIN forms f ON f.word = y.place WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
