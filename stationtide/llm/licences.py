"""Licence passages in files by a positional index of their rarest words.

A template is the wording of a licence; a key phrase inside it is mandatory. Document frequencies over all files tell the
rarest two words of every key phrase. A file is looked at further only if it has such words: their places, moved back
by the place of the word in the template, are the possible starts of the template in the file, and starts that both words
agree on are kept. There the key phrase is compared word by word, and the share of the template's words that stand in
their place is the score. Only built-in functions are used, in one projection without a shuffle; the frequencies are one
aggregate over the words of the key phrases.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAREST = 2


@dataclass(frozen=True)
class Template:
    """Words of a licence text, the part of them that must be there, and the label it earns."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


# The base phrases, and public licence wording with the phrase that each copy has to have.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "this program is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "this library is licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "this program is licensed under the gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def file_words(text: Column) -> Column:
    """Words of a text in order, A-Z lower-cased; null counts as empty."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS), "")


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def document_frequencies(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Number of rows of ``files`` (words) that have each word of the templates' key phrases; as many entries as these words."""
    vocabulary = sorted({w for t in templates for w in t.key_words})
    found = files.select(F.explode(F.array_intersect("words", _literal(vocabulary))).alias("w")).groupBy("w").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r.w: r["count"] for r in found}


def rarest(template: Template, frequencies: dict[str, int], total: int) -> list[tuple[str, int]]:
    """(word, place in the template) of the key phrase's words of highest inverse document frequency; ties by spelling."""
    idf = lambda w: math.log((1 + total) / (1 + frequencies[w]))
    chosen = sorted(set(template.key_words), key=lambda w: (-idf(w), w))[:RAREST]
    return [(w, template.key_at + template.key_words.index(w)) for w in chosen]


def _starts(template: Template, anchors: list[tuple[str, int]]) -> Column:
    """Places, from 0, where the whole template would begin for its key phrase to be where the file has it."""
    agreed = None
    for word, place in anchors:
        own = F.transform(F.filter("postings", lambda p: p["w"] == word), lambda p: p["i"] - place)
        agreed = own if agreed is None else F.array_intersect(agreed, own)
    at, n = template.key_at, len(template.key_words)
    phrase = _literal(template.key_words)
    return F.filter(agreed, lambda s: (s + at >= 0) & (F.slice("words", F.greatest(s + at + 1, F.lit(1)), F.lit(n)) == phrase))


def _coverage(template: Template) -> Column:
    """Largest share of the template's words in their place over its ``starts``."""
    words = _literal(template.words)
    in_place = lambda s: F.aggregate(
        F.sequence(F.lit(0), F.lit(len(template.words) - 1)), F.lit(0),
        lambda n, j: n + F.when((s + j >= 0) & F.coalesce(F.get("words", s + j) == F.get(words, j), F.lit(False)), 1).otherwise(0))
    return in_place


def scan_files(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` of each row of ``docs`` (doc_id, text).

    ``n_base`` counts all places of all base phrases, ``first_word`` and ``last_word`` are the smallest and largest of their
    starts, null without any. Labels are distinct, sorted and comma-joined, empty without any; ``score`` is the best share of
    a found template's words in place, 1 for a base phrase, 0 without any. One output row for each input row, repeated
    rows included; null and empty texts have no words; a null doc_id stays null; an empty table gives an empty result;
    texts are read whole; other columns are not read.
    """
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), file_words(F.col("text")).alias("words"))
    frequencies = document_frequencies(words, templates)
    total = max([1, *frequencies.values()])
    anchors = [rarest(t, frequencies, total) for t in templates]
    needed = _literal(sorted({w for own in anchors for w, _ in own}))
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda p: F.array_contains(needed, p["w"]))
    none = F.array().cast("array<struct<w:string,i:int>>")
    indexed = words.withColumn("postings", F.when(F.arrays_overlap("words", needed), places).otherwise(none))
    empty = F.array().cast("array<int>")
    some = F.size("postings") > 0
    found = indexed.select("doc_id", "words", *(F.when(some, _starts(t, a)).otherwise(empty).alias(f"s{k}") for k, (t, a) in enumerate(zip(templates, anchors))))
    base = [k for k, t in enumerate(templates) if t.base]
    at = F.concat(*(F.transform(f"s{k}", lambda s: s + templates[k].key_at) for k in base))
    hit = lambda keys: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*(
        F.when(F.size(f"s{k}") > 0, F.lit(templates[k].label)) for k in keys)), lambda x: x.isNotNull()))), ",")
    share = [F.when(F.size(f"s{k}") > 0, F.array_max(F.transform(f"s{k}", _coverage(t))) / len(t.words)) for k, t in enumerate(templates)]
    return found.withColumn("at", at).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        hit(base).alias("base_labels"), hit(range(len(templates))).alias("labels"), F.coalesce(F.greatest(*share), F.lit(0.0)).alias("score"))


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """SQL for the rows of :func:`scan_files` over ``documents``, comparing every template at every word."""
    rows = ", ".join(f"('{t.label}', {str(t.base).lower()}, {t.key_at}, string_split('{t.text}', ' '), string_split('{t.key}', ' '))" for t in templates)
    return f"""
WITH t(label, base, key_at, words, phrase) AS (VALUES {rows}),
w AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
p AS (SELECT r, ws, unnest(range(len(ws))) AS i FROM w),
k AS (SELECT p.r, p.i, p.ws, t.* FROM p JOIN t ON p.ws[p.i + 1] = t.phrase[1] AND p.ws[p.i + 1 : p.i + len(t.phrase)] = t.phrase),
c AS (SELECT r, i, label, base, len(list_filter(range(len(words)), lambda j: i - key_at + j >= 0 AND ws[CAST(i - key_at + j + 1 AS BIGINT)] = words[j + 1])) / len(words) AS share FROM k),
g AS (SELECT r, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM c GROUP BY r)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM w LEFT JOIN g ON g.r = w.r"""
