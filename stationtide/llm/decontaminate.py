"""Benchmark passages in documents, with edits, by the q-gram lemma.

A passage of m characters that occurs with at most e edits shares at least m + 1 - q(e + 1) of its q-grams with the
place, all on e + 1 neighbouring diagonals. Shared q-grams are therefore counted in bands of diagonals that overlap by
e, bands that reach the bound are kept as regions, and a banded alignment of the passage inside the region decides.

The bound must be positive, so q may be m / (e + 1) at most. For most lengths ten characters are not too many; passages
for which they are have an index of shorter q-grams of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import ids_and_texts, keep_rows

Q = 10
#: Characters of a q-gram of passages whose bound would not be positive with Q: those of 13 to 19, 25 to 29, 38 and 39.
SHORT_Q = 6
#: Edits for each character of a passage.
EDIT_RATE = 0.08
#: Longer benchmark items are searched as overlapping passages of this many characters, so that a part counts as well.
PASSAGE_CHARS = 200
#: Shorter passages start at every multiple of STRIDE_CHARS and at the item's end less their length. Every excerpt of
#: RUN_CHARS normalised characters holds one of them whole.
SHORT_CHARS = 64
STRIDE_CHARS = 16
RUN_CHARS = SHORT_CHARS + STRIDE_CHARS - 1
#: Characters of benchmark that are searched for in one pass over the documents.
BLOCK_CHARS = 4_000_000
#: Characters of documents that are searched together.
WINDOW_CHARS = 1_000_000
FILTER_BITS = 22
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
GAP = 0x110000  # no character; stands between documents


def normal(text: str | None) -> str:
    """Lower case, white space runs as one blank."""
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    """Edits that a passage of so many characters may have."""
    return int(length * EDIT_RATE)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Polynomial hash of the q characters from each position on, by doubling the window."""
    h = codes.astype(np.uint64) + np.uint64(1)
    have, power, total, total_len = h, BASE, None, 0
    width, left = 1, q
    while left:
        if left & 1:
            if total is None:
                total, total_len = have, width
            else:
                n = len(total) - width
                if n <= 0:
                    return np.zeros(0, np.uint64)
                shift = np.uint64(pow(BASE, width, 1 << 64))
                total = total[:n] * shift + have[total_len:total_len + n]
                total_len += width
        left >>= 1
        if left:
            n = len(have) - width
            if n <= 0:
                return np.zeros(0, np.uint64)
            have = have[:n] * np.uint64(power) + have[width:width + n]
            power, width = power * power % (1 << 64), width * 2
    return total[:max(0, len(codes) - q + 1)]


def windows(texts: list[str | None]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(text, start, normalised characters) of whole texts, in groups of about WINDOW_CHARS. A longer text comes as windows
    that overlap by more than a passage and its edits, so that each place is whole in one of them."""
    group, held, overlap = [], 0, 2 * PASSAGE_CHARS
    for number, text in enumerate(texts):
        codes = code_points(normal(text))
        for at in range(0, max(1, len(codes) - overlap), WINDOW_CHARS - overlap):
            group.append((number, at, codes[at:at + WINDOW_CHARS]))
            held += len(group[-1][2])
            if held >= WINDOW_CHARS:
                yield group
                group, held = [], 0
    if group:
        yield group


@dataclass
class PassageIndex:
    """Passages of one block of the benchmark and the postings of their q-grams."""

    items: np.ndarray      # item of each passage
    codes: list            # its characters
    edits: np.ndarray      # its edit budget
    bound: np.ndarray      # q-grams that a place within the budget shares at least
    width: np.ndarray      # diagonals by which its bands advance
    grams: np.ndarray      # different hashes, ascending
    first: np.ndarray      # start of each hash's postings
    passage: np.ndarray    # postings: passage and offset
    offset: np.ndarray
    filter: np.ndarray     # bit table of the hashes
    q: int = Q
    short: PassageIndex | None = None  # the last passages, which have an index of their own

    @classmethod
    def build(cls, rows: list[tuple[int, str | None]]) -> PassageIndex:
        """Index of the passages of benchmark items (item, text)."""
        items, codes = [], []
        for item, text in rows:
            whole = code_points(normal(text))
            if len(whole) < Q:
                continue
            for size, stride in ((PASSAGE_CHARS, PASSAGE_CHARS // 2), (SHORT_CHARS, STRIDE_CHARS)):
                if size < PASSAGE_CHARS and len(whole) <= size:
                    continue  # is a passage already
                last = max(0, len(whole) - size)
                for start in sorted({*range(0, last, stride), last}):
                    items.append(item)
                    codes.append(whole[start:start + size])
        own = [len(c) >= Q * (budget(len(c)) + 1) for c in codes]
        halves = [([i for i, k in zip(items, own) if k is wanted], [c for c, k in zip(codes, own) if k is wanted]) for wanted in (True, False)]
        index = cls._of(*halves[0], Q)
        if halves[1][0]:
            index.short = cls._of(*halves[1], SHORT_Q)
            index.items = np.concatenate([index.items, index.short.items])
            index.codes, index.edits = index.codes + index.short.codes, np.concatenate([index.edits, index.short.edits])
        return index

    @classmethod
    def _of(cls, items: list[int], codes: list[np.ndarray], q: int) -> PassageIndex:
        length = np.array([len(c) for c in codes], np.int64)
        edits = np.array([budget(n) for n in length.tolist()], np.int64)
        bound = length + 1 - q * (edits + 1)
        assert (bound > 0).all()
        hashes = [gram_hashes(c, q) for c in codes]
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
        passage = np.repeat(np.arange(len(codes), dtype=np.int32), [len(h) for h in hashes])
        offset = np.concatenate([np.zeros(0, np.int32), *(np.arange(len(h), dtype=np.int32) for h in hashes)])
        order = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[order], return_index=True)
        bits = np.zeros(1 << FILTER_BITS, np.bool_)
        bits[_slot(grams)] = True
        return cls(np.array(items, np.int64), codes, edits, bound, edits + 8, grams, np.append(first, len(flat)), passage[order], offset[order], bits, q)

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, passage, start, end, edits) of the best place of each passage in each text, in normalised characters."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        parts = [(self, 0)] + ([(self.short, len(self.codes) - len(self.short.codes))] if self.short else [])
        for group in windows(texts):
            pieces = [codes for _, _, codes in group]
            for part, first in parts:
                for piece, k, start, end, edits in part._search_group(pieces):
                    text, at, _ = group[piece]
                    key, value = (text, first + k), (edits, at + start, at + end)
                    best[key] = min(best.get(key, value), value)
        return [(t, k, i, j, e) for (t, k), (e, i, j) in sorted(best.items())]

    def _search_group(self, pieces: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        gap = np.full(PASSAGE_CHARS * 2, GAP, np.uint32)
        buffer = np.concatenate([x for codes in pieces for x in (codes, gap)])
        starts = np.concatenate(([0], np.cumsum([len(c) + len(gap) for c in pieces])))[:-1]
        hashes = gram_hashes(buffer, self.q)
        if not len(hashes) or not len(self.grams):
            return []
        at = np.flatnonzero(self.filter[_slot(hashes)])
        known = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        same = self.grams[known] == hashes[at]
        at, known = at[same], known[same]
        n = self.first[known + 1] - self.first[known]
        posting = np.repeat(self.first[known] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else n
        place, passage = np.repeat(at, n), self.passage[posting].astype(np.int64)
        return self._align(buffer, starts, [len(c) for c in pieces], self._regions(place - self.offset[posting], passage))

    def _regions(self, diagonal: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """(passage, first diagonal) of the bands with enough shared q-grams; band b holds width + edits + 1 diagonals."""
        width, edits = self.width[passage], self.edits[passage]
        band = diagonal // width
        also = diagonal - band * width <= edits
        keys = np.concatenate([np.stack([passage, band]), np.stack([passage[also], band[also] - 1])], axis=1)
        if not keys.shape[1]:
            return keys
        packed, count = np.unique((keys[0] << 40) + (keys[1] + (1 << 39)), return_counts=True)
        full = count >= self.bound[packed >> 40]
        passage, band = packed[full] >> 40, (packed[full] & ((1 << 40) - 1)) - (1 << 39)
        return np.stack([passage, band * self.width[passage]])

    def _align(self, buffer, starts, lengths, regions) -> list[tuple[int, int, int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at in range(0, regions.shape[1], 256):
            passage, diagonal = regions[:, at:at + 256]
            own = [self.codes[p] for p in passage.tolist()]
            edits, start, end = banded_alignments(own, buffer, diagonal, self.width[passage] + self.edits[passage], self.edits[passage])
            # A place within the budget is nearly all text, so that its middle is in the document, whatever its ends are.
            text = np.searchsorted(starts, np.clip((start + end) // 2, 0, len(buffer) - 1), "right") - 1
            low = starts[text]
            high = low + np.asarray(lengths)[text]
            rows = np.stack([text, passage, edits, np.clip(start, low, high) - low, np.clip(end, low, high) - low], axis=1)
            for t, k, e, i, j in rows[edits >= 0].tolist():
                best[t, k] = min(best.get((t, k), (e, i, j)), (e, i, j))
        return [(t, k, i, j, e) for (t, k), (e, i, j) in sorted(best.items())]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * MIX) >> np.uint64(64 - FILTER_BITS)


def banded_alignments(patterns: list, buffer: np.ndarray, diagonal: np.ndarray, spread: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """(edits, start, end) of the best place in ``buffer`` of each whole pattern that starts on its diagonals ``diagonal`` to
    ``diagonal + spread``; edits is -1 above the budget. All patterns are aligned together: row i of the tables has the
    cells of a pattern's diagonals, up to ``edits`` beyond that range on either side. A gap between documents is never
    worth more than leaving the pattern's character out, and is wider than a band is long."""
    length = np.array([len(c) for c in patterns])
    size = spread + 2 * edits + 1
    wide, far, pad = int(size.max()), 1 << 20, PASSAGE_CHARS * 2
    chars = np.full((len(patterns), int(length.max())), GAP + 1, np.uint32)
    for k, codes in enumerate(patterns):
        chars[k, :len(codes)] = codes
    steps = np.arange(wide)
    outside = steps >= size[:, None]
    begin = (diagonal - edits)[:, None] + steps
    padded = np.concatenate([np.full(pad, GAP, np.uint32), buffer, np.full(pad, GAP, np.uint32)])
    place = begin + pad
    row = np.where(outside, far, 0)
    out = np.full((3, len(patterns)), -1)
    live = np.arange(len(patterns))
    edge = np.full((len(patterns), 1), far)
    for i in range(chars.shape[1]):
        new = row + (padded[place + i] != chars[:, i:i + 1])
        up = np.concatenate([row[:, 1:] + 1, edge], axis=1)  # the pattern's character has no partner
        better = up < new
        origin = np.where(better, np.concatenate([begin[:, 1:], edge], axis=1), begin)
        level = np.minimum(new, up) - steps
        run = np.minimum.accumulate(level, axis=1)  # the text's characters have no partner
        begin = np.take_along_axis(origin, np.maximum.accumulate(np.where(level == run, steps, 0), axis=1), axis=1)
        row = np.where(outside, far, run + steps)
        least = row.min(axis=1)
        done = (length == i + 1) & (least <= edits)
        if done.any():
            at = row[done].argmin(axis=1)
            out[:, live[done]] = least[done], begin[done, at], place[done, at] - pad + i + 1
        keep = (least <= edits) & (length > i + 1)
        if keep.sum() <= 0.7 * len(keep):
            if not keep.any():
                break
            row, begin, place, outside, chars, edge = (x[keep] for x in (row, begin, place, outside, chars, edge))
            length, edits, live = length[keep], edits[keep], live[keep]
    return out


def benchmark_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about BLOCK_CHARS, each small enough for the driver and for every task."""
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for k in range(n):
        own = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield sorted((r.item_id, r.text) for r in own.toLocalIterator())


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``start``, ``end`` for each document and benchmark item of which it holds a passage.

    A passage is a whole item of up to PASSAGE_CHARS characters, PASSAGE_CHARS of a longer one, or SHORT_CHARS of any longer
    than that, each with its own budget of EDIT_RATE. An excerpt of RUN_CHARS (79) or more characters of an item is found
    wherever it is cut out; a shorter excerpt of a longer item need not be.

    The place counts characters of the document in lower case with single blanks; of several passages or places the one
    with the fewest edits, then the first, is given. Null and empty texts, null items and items of fewer than Q
    characters match nothing. Repeated documents have a row each; repeated items count once. Rows without doc_id are found
    with a null id. Empty tables give an empty result; other columns are not read. The benchmark is a stated query set:
    it is searched block by block, all documents for each block.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, edits int, start long, end long"
    found = None
    for block in benchmark_blocks(benchmark):
        part = texts.mapInArrow(_searcher(PassageIndex.build(block)), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _searcher(index: PassageIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=1_000_000):
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for text, passage, start, end, edits in index.search(texts):
                    key, value = (text, int(index.items[passage])), (edits, start, end)
                    best[key] = min(best.get(key, value), value)
                rows = sorted(best.items())
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([k[0] for k, _ in rows], pa.int64())), pa.array([k[1] for k, _ in rows], pa.int64()),
                    *(pa.array([v[c] for _, v in rows], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))),
                ], ["doc_id", "item_id", "edits", "start", "end"])

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, all columns unchanged."""
    for block in benchmark_blocks(benchmark):
        docs = keep_rows(docs, _clean(PassageIndex.build(block)))
    return docs


def _clean(index: PassageIndex):
    def decide(texts: list[str | None]) -> np.ndarray:
        keep = np.ones(len(texts), bool)
        keep[[text for text, *_ in index.search(texts)]] = False
        return keep

    return decide
