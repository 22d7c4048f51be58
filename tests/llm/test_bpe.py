import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("voxmeter.llm")
tiktoken = pytest.importorskip("tiktoken")

from voxmeter.llm import bpe  # noqa: E402

PATH = bpe.DEFAULT_VOCABULARY
if not os.path.exists(PATH):
    pytest.skip("no vocabulary", allow_module_level=True)


@pytest.fixture(scope="module")
def both():
    e = bpe.encoder()
    return e, tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=e.ranks, special_tokens={})


def test_hash_is_perfect_and_minimal(both):
    e, _ = both
    assert sorted(e.hash.at.tolist()) == list(range(len(e.keys)))
    assert e.hash.lookup(e.keys).tolist() == list(range(len(e.keys)))
    for n in (0, 1, 2, 7):
        h = bpe.PerfectHash([str(i).encode() for i in range(n)])
        assert sorted(h.lookup([str(i).encode() for i in range(n)]).tolist()) == list(range(n))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    e = bpe.encoder()
    ref = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    assert e.encode([text])[0] == ref.encode_ordinary(text)


def test_long_words_and_markup(both):
    e, ref = both
    rng = random.Random(0)
    texts = ["a" * 30_000, "".join(rng.choice("abcdeфы☃") for _ in range(5_000)), "<|endoftext|> <|startoftext|>", "   \n\t  x  ", "'s 're 'll"]
    assert e.encode(texts) == [ref.encode_ordinary(t) for t in texts]


def test_column(spark):
    rows = [(1, "Hello, world", "x"), (2, "", "y"), (3, None, "z"), (1, "Hello, world", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(df, "doc_id", "text")
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    ids = bpe.encoder().encode(["Hello, world"])[0]
    assert sorted((r["doc_id"], list(r["ids"])) for r in got.collect()) == [(1, ids), (1, ids), (2, []), (3, [])]
    assert bpe.encode_documents(df.limit(0), "doc_id", "text").count() == 0


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    e = bpe.Encoder()
    assert e.encode(["a bb ccc dddd"]) == e.encode(["a bb ccc dddd"]) and len(e.memo) <= 8
