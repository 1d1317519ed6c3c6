import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbung.llm import tokens

V = tokens.Vocabulary.load()
E = tokens.Encoder(V)
REFERENCE = tiktoken.Encoding("own", pat_str=V.split.pattern, mergeable_ranks=V.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="ab -=_<|>é漢\n\t ", max_size=200)))
def test_same_as_the_public_encoder(text):
    assert E.encode(text) == REFERENCE.encode_ordinary(text)


def test_long_words_and_bound():
    for text in ("a" * 3000, "ÃÂ" * 900, "-" * 2500 + "x", " " * 1000, "abcdefghij" * 400, "<|endoftext|>", "=" * 777 + "漢字" * 300):
        t = tokens.Transducer(V)
        assert E.encode(text) == REFERENCE.encode_ordinary(text)
        t.push(text.encode())
        assert t.pending <= V.lookahead and len(t.last) <= V.lookahead


def test_windows_do_not_change_ids():
    text = ("kata  kunci\n\n penelitian, \t 2024 " * 900) + "z" * 500
    assert "".join(tokens.windows(text, 100)) == text
    assert [i for w in tokens.windows(text, 100) for x in V.split.findall(w) for i in E.word(x)] == REFERENCE.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_token_by_token(text):
    d = tokens.Decoder(V)
    assert "".join(d.push([i]) for i in E.encode(text)) + d.end() == text


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "halo dunia", "x"), (3, "halo dunia", "x"), (4, "kata " * 40000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in tokens.encode(df, keep=["doc_id"]).collect())
    assert got == sorted((i, REFERENCE.encode_ordinary(t or "")) for i, t, _ in rows)
    assert tokens.encode(df.limit(0)).count() == 0
