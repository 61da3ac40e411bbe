import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stationtide.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(PATH)
    out.no_padding()
    out.no_truncation()
    return out


def odd_texts():
    rng = np.random.default_rng(11)
    out = ["", " ", "\n\n \t", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "don't we'll I'VE 'tis", "123,456.78 ½ Ⅷ", "日本語のテキスト 中文", "🙂🙃👩‍👩‍👧", "\u200b\u200d\ufeff",
           "e\u0301 \u00e9", "\x00\x01\x7f", "x" * 5000, "ab " * 3000, "\u2028\u00a0 \u3000z", "ſ İ ı ß", "a\r\nb\r\n", "   lead and trail   "]
    marks = list("abcdeXYZ  \n\t'\"0123.,;<>|éßñ中語🙂\u200d\x00")
    return out + ["".join(rng.choice(marks, rng.integers(1, 60))) for _ in range(600)]


def want(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_equals_the_library_on_odd_texts(frame, tokenizer):
    rows = list(enumerate(odd_texts())) + [(9000, None), (9001, "same"), (9001, "same"), (None, "no id")]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n_tokens", "'x' AS decoded")
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest_documents(docs, PATH).collect()), key=str)
    assert got == sorted(((i, *want(tokenizer, t)) for i, t in rows), key=str)


def test_equals_the_library_on_a_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest_documents(docs, PATH).collect())
    assert got == sorted((r.doc_id, *want(tokenizer, r.text)) for r in docs.collect())


def test_empty_table(frame):
    assert bpe.digest_documents(frame([], "doc_id long, text string"), PATH).count() == 0
