import public_tokenizers
from hypothesis import given, settings, strategies as st

from stationtide.llm import tokencount

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, initial, following):
    at, n = 0, 0
    while at < len(word):
        own = initial if at == 0 else following
        end = next((e for e in range(len(word), at, -1) if word[at:e] in own), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.lists(st.text("abcd", min_size=1, max_size=14), max_size=20))
def test_any_vocabulary_counts_like_greedy_matching(initial, following, words):
    counter = tokencount.PieceCounter(sorted(initial), sorted(following))
    assert [counter.word(w) for w in words] == [greedy(w, initial, following) for w in words]


def test_public_vocabulary_over_the_tables(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    initial, following = {p[1:] for p in plain if p[0] == "▁" and len(p) > 1}, {p for p in plain if "▁" not in p}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = {}
    for r in docs.collect():
        counts = [greedy(w, initial, following) for w in tokencount.WORD.findall(r.text)]
        want[r.doc_id] = (len(counts), sum(map(abs, counts)), sum(c < 0 for c in counts))
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in tokencount.count_tokens(docs, PATH).collect()}
    assert got == want and any(n > w for w, n, _ in want.values())


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "the the"), (4, "the the"), (None, "the"), (5, "\U0010fffd ok"), (6, "the" * 100_000)]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS n_tokens")
    got = sorted(map(tuple, tokencount.count_tokens(docs, PATH).collect()), key=str)
    assert {g[0]: g[1:] for g in got if g[0] in (1, 2, 3)} == {1: (0, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0)}
    assert [g for g in got if g[0] in (4, None)] == [(4, 2, 2, 0), (4, 2, 2, 0), (None, 1, 1, 0)]
    assert [g for g in got if g[0] == 5] == [(5, 2, 2, 1)]
    assert [g[1] for g in got if g[0] == 6] == [1]
    assert tokencount.count_tokens(docs.limit(0), PATH).count() == 0
