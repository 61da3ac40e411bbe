"""Greedy word-piece lengths by one linear pass of an automaton.

The vocabulary is a trie with two roots, one for pieces that begin a word and one for those that continue it. A node
whose string cannot be extended has a failure link: to the node where matching goes on once the longest pieces of its
string have been taken off, together with the number of these pieces. Counting follows the characters through nodes and
links and adds up the numbers, so that no piece is ever built and every character is looked at once.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationtide.llm.common import ids_and_texts

#: Runs of letters and digits are words; every other visible character is a word of its own.
WORD = re.compile(r"[^\W_]+|[^\w\s]|_")
#: Words after which a worker forgets their counts; only a bound on memory.
MEMO_WORDS = 500_000
WIDTH = 0x110000


class PieceCounter:
    """Counts the pieces of the greedy longest-match-first split of words."""

    def __init__(self, initial: Iterable[str], following: Iterable[str]):
        self.step: dict[int, int] = {}
        children: list[list[tuple[str, int]]] = [[], []]
        final = [False, False]
        for root, pieces in ((0, initial), (1, following)):
            for piece in pieces:
                node = root
                for char in piece:
                    key = node * WIDTH + ord(char)
                    below = self.step.get(key)
                    if below is None:
                        below = self.step[key] = len(children)
                        children[node].append((char, below))
                        children.append([])
                        final.append(False)
                    node = below
                if node != root:
                    final[node] = True
        #: Where matching goes on when a node cannot be extended (-1: nowhere), and the pieces taken off on the way.
        self.link = [-1] * len(children)
        self.popped = [0] * len(children)
        todo = deque([0, 1])
        while todo:
            node = todo.popleft()
            for char, below in children[node]:
                todo.append(below)
                if final[below]:
                    self.link[below], self.popped[below] = 1, 1
                    continue
                at, popped = self.link[node], self.popped[node]
                while at >= 0:
                    onward = self.step.get(at * WIDTH + ord(char))
                    if onward is not None:
                        self.link[below], self.popped[below] = onward, popped
                        break
                    popped += self.popped[at]
                    at = self.link[at]
        self.memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of the word, or -1 if it cannot be split."""
        step, link, popped = self.step, self.link, self.popped
        node = count = 0
        for char in word:
            key = ord(char)
            onward = step.get(node * WIDTH + key)
            while onward is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return -1
                onward = step.get(node * WIDTH + key)
            node = onward
        while node != 1:
            count += popped[node]
            node = link[node]
            if node < 0:
                return -1
        return count

    def text(self, text: str | None) -> tuple[int, int, int]:
        """(words, tokens, unknown words) of a text; an unknown word is one token."""
        words = WORD.findall(text) if text else []
        if not words:
            return 0, 0, 0
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = self.word(w)
        counts = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        return len(words), int(np.abs(counts).sum()), int((counts < 0).sum())


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    """From a sentence-piece file: pieces that carry the word mark begin a word, the others continue it; byte, control
    and unknown pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    mark = "▁"
    return PieceCounter((p[1:] for p in plain if p.startswith(mark) and mark not in p[1:] and len(p) > 1), (p for p in plain if mark not in p))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens``, ``n_unknown`` of each row of ``docs`` (doc_id, text).

    One output row for each input row, repeated rows included. Null, empty and blank texts have no words; a null doc_id
    stays null; an empty table gives an empty result; texts are read whole; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for batch in batches:
            for ids, texts in ids_and_texts(batch):
                rows = np.array([counter.text(t) for t in texts], np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c) for c in rows.T)], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
