"""Byte-pair encoding by walking a trie of distinct words.

The distinct words of a slice of documents are visited in byte order, which is a depth-first walk of their trie: the
stack holds, for every prefix on the current path, the last token of that prefix's encoding, and a word that shares a
prefix with the one before starts from the state it left there. The encoding of a prefix p is the encoding of the
shorter prefix that its last token leaves, plus that token; among the vocabulary's suffixes of p exactly one token t
qualifies: t encodes to itself, and no merge would cross the border between t and the token before it. The words
are then read back along the last tokens.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import ids_and_texts

# Fixed value: the word pattern of the byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = regex.compile(WORD_PATTERN)

#: Entries after which a worker forgets its tables of word encodings and token pairs; only a bound on memory.
MEMO_ENTRIES = 300_000


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for themselves, the others follow from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairCodec:
    """Vocabulary, merges and added tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        alphabet = byte_alphabet()
        plain = lambda token: bytes(alphabet[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.token_bytes: dict[int, bytes] = {i: plain(t) for t, i in vocab.items()}
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.added.items():
            self.token_bytes[i] = content.encode()
        self.ids: dict[bytes, int] = {plain(t): i for t, i in vocab.items() if t not in self.added}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.merged: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.merge_rank[a, b] = rank
            self.merged[rank] = c
            if c not in self.rank:
                self.rank[c], self.parts[c] = rank, (a, b)
        self.ids = {b: i for b, i in self.ids.items() if len(b) == 1 or self.whole(i)}
        self.longest = max(map(len, self.ids))
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pair_memo: dict[tuple[int, int], bool] = {}
        self.word_memo: dict[str, bytes] = {}

    def whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token itself; only such tokens can end a prefix."""
        parts = [self.ids[bytes([b])] for b in self.token_bytes[token]]
        while len(parts) > 1:
            ranks = [self.merge_rank.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            lowest = min(ranks)
            if lowest == 1 << 60:
                return False
            at = ranks.index(lowest)
            parts[at:at + 2] = [self.merged[lowest]]
        return parts == [token]

    def border_holds(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two adjacent tokens.

        Undoes the merges on both sides of the border, the latest first. A merge across it takes place when its rank
        comes before those that took up its two parts; at equal ranks the one further left goes first.
        """
        a, b = left, right
        taken_a = taken_b = 1 << 60
        holds = True
        while True:
            crossing = self.merge_rank.get((a, b))
            if crossing is not None and crossing < taken_a and crossing <= taken_b:
                holds = False
                break
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a > rank_b:
                taken_a, a = rank_a, self.parts[a][1]
            else:
                taken_b, b = rank_b, self.parts[b][0]
        self.pair_memo[left, right] = holds
        return holds

    def encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Token ids of each word as little-endian 32-bit integers."""
        ids, longest, pairs, out = self.ids, self.longest, self.pair_memo, {}
        if len(pairs) > MEMO_ENTRIES:
            pairs.clear()
        tokens: list[int] = []   # last token of each prefix on the path
        lengths: list[int] = []  # and its length
        before = b""
        for data, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            shared = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                shared += 1
            del tokens[shared:], lengths[shared:]
            for end in range(shared + 1, len(data) + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = ids.get(data[start:end])
                    if token is None:
                        continue
                    if start:
                        left = tokens[start - 1]
                        holds = pairs.get((left, token))
                        if not (self.border_holds(left, token) if holds is None else holds):
                            continue
                    tokens.append(token)
                    lengths.append(end - start)
                    break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            found, end = [], len(data)
            while end:
                found.append(tokens[end - 1])
                end -= lengths[end - 1]
            found.reverse()
            packed = array("I", found)
            out[word] = packed.tobytes()
            before = data
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each whole text; null counts as empty. Strings of added tokens become those tokens."""
        pieces: list[list] = []
        for text in texts:
            row: list = []
            if text:
                at = 0
                if self.split_added is not None:
                    for hit in self.split_added.finditer(text):
                        row.append(WORDS.findall(text, at, hit.start()) if hit.start() > at else [])
                        row.append(array("I", [self.added[hit[0]]]).tobytes())
                        at = hit.end()
                row.append(WORDS.findall(text[at:] if at else text))
            pieces.append(row)
        memo = self.word_memo
        new = {w for row in pieces for part in row if isinstance(part, list) for w in part if w not in memo}
        if len(memo) + len(new) > MEMO_ENTRIES:
            memo.clear()
            new = {w for row in pieces for part in row if isinstance(part, list) for w in part}
        memo.update(self.encode_words(new))
        lookup = memo.__getitem__
        return [b"".join(b"".join(map(lookup, part)) if isinstance(part, list) else part for part in row) for row in pieces]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """One codec for each worker process and file."""
    return BytePairCodec(path)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``decoded`` (string) of each row of ``docs`` (doc_id, text).

    One output row for each input row, repeated rows included. A null or empty text has no ids and decodes to the empty
    string; a null doc_id stays null; an empty table gives an empty result; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(tokenizer_path)
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=2_000_000):
                packed = tokenizer.encode_batch(texts)
                lists = pa.ListArray.from_arrays(
                    pa.array([0, *_running(len(p) // 4 for p in packed)], pa.int32()),
                    pa.Array.from_buffers(pa.int32(), sum(map(len, packed)) // 4, [None, pa.py_buffer(b"".join(packed))]))
                yield pa.RecordBatch.from_arrays([ids, lists, pa.array(map(tokenizer.decode, packed), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each row, with the same rules as :func:`encode_documents`;
    ids and texts stay inside the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = codec(tokenizer_path)
        for batch in batches:
            for ids, texts in ids_and_texts(batch, max_chars=2_000_000):
                packed = tokenizer.encode_batch(texts)
                decoded = (tokenizer.decode(p).encode() for p in packed)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _running(counts) -> Iterator[int]:
    total = 0
    for n in counts:
        total += n
        yield total
