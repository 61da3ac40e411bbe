import random
import re

from stationtide.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(doc_id, text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels, base_labels, score = [], set(), set(), 0.0
    for t in licences.TEMPLATES:
        key = t.key_words
        for i in range(len(words)):
            if words[i:i + len(key)] == key:
                s = i - t.key_at
                score = max(score, sum(0 <= s + j < len(words) and words[s + j] == w for j, w in enumerate(t.words)) / len(t.words))
                labels.add(t.label)
                if t.base:
                    base_labels.add(t.label)
                    starts.append(i)
    return (doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), round(score, 9))


def found(docs):
    return sorted(((*r[:7], round(r.score, 9)) for r in licences.scan_files(docs).collect()), key=str)


def test_matches_every_place(frame):
    rng = random.Random(1)
    rows = [(1, None), (2, ""), (3, " ;\n"), (4, "MIT License"), (4, "MIT License"), (None, "cc-by-nc 4.0"), (5, "mit mit license license mit  license"),
            (6, "KKby cc byé cc Éby cc, by"), (7, "filler " * 100_000 + "Apache License, Version 2.0"), (8, "general public license version 3 gnu"), (9, "cc by " * 3000)]
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(licences.TEMPLATES).words
            a = rng.randint(0, 3)
            words = words[a if rng.random() < 0.4 else 0:]
            if words and rng.random() < 0.3:
                words[rng.randrange(len(words))] = "other"
            parts += words + [rng.choice(["x", "license", "gnu", "by", "permission"]) for _ in range(rng.randint(0, 5))]
        rows.append((100 + i, rng.choice([" ", "-", " \n", "; "]).join(parts)))
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS postings", "3 AS s0", "4 AS at")
    assert found(docs) == sorted((brute(*r) for r in rows), key=str)
    assert licences.scan_files(docs.limit(0)).count() == 0


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert found(docs) == want and any(w[2] for w in want)


def test_rarest_words_follow_the_corpus():
    t = next(t for t in licences.TEMPLATES if t.label == "gpl")
    assert [w for w, _ in licences.rarest(t, {"gnu": 5, "general": 900, "public": 800, "license": 7}, 1000)] == ["gnu", "license"]
    assert licences.rarest(t, dict.fromkeys(t.key_words, 1), 10) == [("general", 1), ("gnu", 0)]


def test_no_python_on_the_main_path(spark):
    plan = licences.scan_files(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan
