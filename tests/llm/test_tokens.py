from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest
from brute import best_pieces
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rotativa.llm import prefix_counts, unigram
from rotativa.llm.pieces import MARK, double_array, load_vocabulary

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

PATH = unigram.default_vocabulary()
VOCABULARY = load_vocabulary(PATH)
MODEL = unigram.Unigram(VOCABULARY)
COUNTER = prefix_counts.PrefixCounter(VOCABULARY)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
KNOWN = {p: s for p, s, n in zip(VOCABULARY.pieces, MODEL.scores.tolist(), VOCABULARY.normal) if n}
TEXTS = ["", " ", "  a", "a  b ", MARK, f"{MARK}x {MARK} y{MARK}", "\n\n a\n", "日本語 テキスト 𝄞", "a\tb\x00c", "x" * 500, " \n ", "\n", "Hello, world! " * 30]
SOME = st.text(st.sampled_from(list("ab ▁\n é字𝄞thein,.0")), max_size=60)


def binary(texts):
    return pa.array([t.encode() for t in texts], pa.large_binary())


def split(values, sizes):
    return [v.tolist() for v in np.split(values, np.cumsum(sizes)[:-1])]


def test_double_array_finds_every_key_and_no_other():
    keys = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff": 4, b"ca": 5}
    base, check, value = double_array(keys)

    def find(key):
        state = 0
        for byte in key:
            following = base[state] + byte
            if check[following] != state:
                return -1
            state = following
        return value[state]

    assert {k: find(k) for k in keys} == keys
    assert [find(k) for k in (b"c", b"ac", b"abcd", b"\x00")] == [-1] * 4


@pytest.mark.parametrize("more", [[], ["repeat " * 5000]])
def test_round_trip(more):
    texts = TEXTS + more
    values, sizes = MODEL.encode(binary(texts))
    data, lengths = MODEL.decode(values, sizes)
    ends = np.cumsum(lengths)
    assert [data[b - n : b].tobytes().decode() for b, n in zip(ends, lengths)] == texts


@settings(max_examples=60, deadline=None, derandomize=True)
@given(SOME)
def test_best_path_and_round_trip(text):
    values, sizes = MODEL.encode(binary([text]))
    data, _ = MODEL.decode(values, sizes)
    assert data.tobytes().decode() == text
    if MARK in text or not text:
        return
    marked = MARK + text.replace(" ", MARK)
    unknown = sum(c not in KNOWN for c in marked)
    score = sum(MODEL.scores[v] for v in values if VOCABULARY.normal[v]) + unknown * MODEL.unknown
    assert score == pytest.approx(best_pieces(KNOWN, MODEL.unknown, marked))


def test_same_pieces_as_the_library():
    """The library's unigram model, over a model file of the same pieces and scores."""

    def field(number, kind, payload):
        if kind == 2:
            size, head = len(payload), b""
            while size > 127:
                head, size = head + bytes([size & 127 | 128]), size >> 7
            payload = head + bytes([size]) + payload
        key, head = number << 3 | kind, b""
        while key > 127:
            head, key = head + bytes([key & 127 | 128]), key >> 7
        return head + bytes([key]) + payload

    scores = MODEL.scores.astype(np.float32)
    made = b""
    for i, piece in enumerate(VOCABULARY.pieces):
        kind = 2 if i == 0 else 3 if i < 3 else 1 if VOCABULARY.normal[i] else 6
        score = float(scores[i]) if VOCABULARY.normal[i] else 0.0
        made += field(1, 2, field(1, 2, piece.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    made += field(2, 2, field(3, 0, b"\x01") + field(35, 0, b"\x01"))
    made += field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))
    library = sentencepiece.SentencePieceProcessor(model_proto=made)
    single = unigram.Unigram(VOCABULARY, scores.astype(float))
    texts = ["The quick brown fox jumps over the lazy dog", "a  b", " Été à la plage, 日本 𝄞", "x\ny z", "internationalization of 1234567"]
    values, sizes = single.encode(binary(texts))
    for text, found in zip(texts, split(values, sizes)):
        assert found == library.encode(text), text


def test_counts_of_all_prefixes_equal_the_library():
    texts = [t[:60] for t in TEXTS]
    values, lengths = COUNTER.counts(binary(texts))
    for text, found in zip(texts, split(values, lengths)):
        assert found == [len(LIBRARY.encode(text[:n])) for n in range(1, len(text) + 1)], text


@settings(max_examples=60, deadline=None, derandomize=True)
@given(SOME)
def test_counts_of_any_text(text):
    values, _ = COUNTER.counts(binary([text]))
    assert values.tolist() == [len(LIBRARY.encode(text[:n])) for n in range(1, len(text) + 1)]


def test_longest_prefix_within_a_budget():
    values, lengths = np.array([1, 2, 3, 2, 5, 1, 9]), np.array([5, 0, 1, 1])
    assert prefix_counts.longest_within(values, lengths, 2).tolist() == [4, 0, 1, 0]
    assert prefix_counts.longest_within(values, lengths, 9).tolist() == [5, 0, 1, 1]


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, repeats, empty and very long texts, and columns whose names the operators use as well."""
    rows = [(1, "a b", 1), (1, "a b", 1), (2, None, 2), (None, "x", 3), (3, "", 4), (4, "lorem ipsum " * 60_000, 5), (5, "z" * 50_000, None)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, n_tokens INT")


def test_odd_rows(spark, odd):
    encoded = unigram.encode_texts(odd, ("doc_id",)).collect()
    counted = prefix_counts.token_counts(odd, ("doc_id",), limit=10).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert len(encoded) == len(counted) == 7 and all(r.round_trip for r in encoded)
    for text, one, other in zip(texts, encoded, counted):
        assert one.n_bytes == other.n_bytes == len(text.encode())
        assert one.n_tokens == len(one.tokens)
        assert other.n_tokens == len(LIBRARY.encode(text)) and other.over_limit == (other.n_tokens > 10)
        assert len(LIBRARY.encode(text[: other.chars_within])) <= 10
    empty = odd.limit(0)
    assert unigram.encode_texts(empty, ("doc_id",)).count() == prefix_counts.token_counts(empty, ("doc_id",)).count() == 0


def test_tokens_are_decoded(spark, odd):
    encoded = unigram.encode_texts(odd, ("doc_id",))
    texts = {r.text or "" for r in odd.collect()}
    assert {r.text for r in unigram.decode_tokens(encoded, ("doc_id",)).collect()} == texts
    gone = encoded.select("doc_id", F.lit(None).cast("array<int>").alias("tokens")).limit(1)
    assert unigram.decode_tokens(gone, ("doc_id",)).first().text is None


def test_prefix_arrays(spark):
    rows = spark.createDataFrame([(1, "The cat sat"), (2, "")], "doc_id LONG, text STRING")
    found = prefix_counts.token_counts(rows, ("doc_id",), prefixes=True).orderBy("doc_id").collect()
    assert found[0].prefix_tokens == [len(LIBRARY.encode("The cat sat"[:n])) for n in range(1, 12)]
    assert found[1].prefix_tokens == []
