"""Lockstep alignment against plain loops over the libraries' tokens of whole texts."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import sha
from pyspark.sql import functions as F

from rotativa.llm import lockstep
from rotativa.llm.pieces import MARK
from rotativa.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

FOLDER = "/root/testdata/sf0.001"
A_PATH, B_PATH = lockstep.default_vocabularies()
A = tokenizers.Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = lockstep.byte_letters()


def tokens(text: str | None):
    """(id, bytes) of both encodings of the whole text, or nothing."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[1:-1], 16)]) if B.is_byte(i) else piece.replace(MARK, " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def grouped(a, b):
    ends = lambda items: np.cumsum([len(x) for _, x in items]).tolist()
    cuts = sorted(set(ends(a)) & set(ends(b)))
    groups = [([], []) for _ in cuts]
    for side, items in enumerate((a, b)):
        for (number, _), end in zip(items, ends(items)):
            groups[np.searchsorted(cuts, end)][side].append(number)
    return groups


def expected(rows):
    """The contract over (doc_id, text) rows."""
    cut = [(i, *tokens(t)) for i, t in rows]
    found = [(i, a, b, grouped(a, b)) for i, a, b in cut]
    held = Counter()
    for *_, groups in found:
        held.update({(x, y) for one, other in groups for x in one for y in other})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    made = []
    for i, a, b, groups in found:
        links = [(x, y) for one, other in groups for x in one for y in other]
        written = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, other)) for one, other in groups)
        made.append((
            i, len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
            sha(written) if a else "",
        ))
    return made


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ORDER = lambda r: tuple((x is not None, x) for x in r)


def test_query(spark):
    got = QUERIES["op12_lockstep"](spark, FOLDER)
    assert got.columns == COLUMNS
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=ORDER) == sorted(expected(docs), key=ORDER)


TEXTS = [
    None, "", " ", "  two  spaces ", "a\n\n b\t c", f"a{MARK}b", "<|endoftext|> </s> <s> <unk> <0x41>", "日本語 テキスト 𝄞 👩‍👩‍👧", "x" * 3_000,
    "=" * 500 + " " * 300 + "-", "é é ﬁ Ⅷ    .", "don't we'll I'D", "\x00 \x1c a\x1f b", "word " * 5_000 + "end", "qwxzjk" * 700, "同じ" * 400,
]


@pytest.mark.parametrize("block", [1, 8_000_000])
def test_edges(spark, monkeypatch, block):
    monkeypatch.setattr(lockstep, "BLOCK_BYTES", block)
    monkeypatch.setattr(lockstep, "SENT_ROWS", 0 if block == 1 else 500_000)
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (7, "the the the"), (7, "the the the")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    clashing = docs.withColumns({"block": F.lit("x"), "pair": F.lit(1), "n_a": F.lit(0), "doc": F.lit(2)})
    got = lockstep.counted_alignments(clashing, ("doc_id",))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=ORDER) == sorted(expected(rows), key=ORDER)


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert lockstep.counted_alignments(none, ("doc_id",)).count() == 0 and lockstep.alignments(none, ()).count() == 0


def test_alignments(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id LONG, text STRING")
    for row in lockstep.alignments(docs, ("doc_id",)).collect():
        a, b = tokens(TEXTS[row.doc_id])
        assert (row.a_ids, row.b_ids) == ([i for i, _ in a], [i for i, _ in b])
        ends = lambda cuts: list(zip([0, *cuts], cuts))
        parts = [(row.a_ids[x:y], row.b_ids[z:w]) for (x, y), (z, w) in zip(ends(row.a_cuts), ends(row.b_cuts))]
        assert parts == grouped(a, b)


@pytest.mark.parametrize("entered", [1, 3, 512])
def test_merging(monkeypatch, entered):
    """Random ends, groups without a common end for long, and both ways of writing links."""
    monkeypatch.setattr(lockstep, "ENTERED", entered)
    random_ = random.Random(entered)
    for _ in range(200):
        ends, counts, a_all, b_all, base = [], [], [], [], 0
        for _ in range(random_.randint(1, 4)):
            size = random_.randint(1, 60)
            a = sorted({size, *random_.sample(range(1, size + 1), random_.randint(1, size))})
            b = sorted({size, *random_.sample(range(1, size + 1), random_.randint(1, size))})
            a_all += [base + x for x in a]
            b_all += [base + x for x in b]
            counts.append(len(a))
            base += size
        groups = lockstep.merged(np.array(a_all), np.array(b_all), np.array(counts))
        cuts = sorted(set(a_all) & set(b_all))
        assert [a_all[i] for i in groups[1]] == cuts == [b_all[i] for i in groups[3]]
        assert groups[0].tolist() == [0, *(groups[1] + 1)[:-1].tolist()] and groups[2].tolist() == [0, *(groups[3] + 1)[:-1].tolist()]


def test_links_of_wide_groups(monkeypatch):
    a, b = np.array([5, 5, 6, 7, 7, 8]), np.array([1, 2, 2, 3, 1])
    groups = np.array([[0, 5], [4, 5], [0, 4], [3, 4]])
    want = Counter((0 << 32) | (x * 10 + y) for x in a[:5].tolist() for y in b[:4].tolist())
    want[(1 << 32) | (8 * 10 + 1)] += 1
    for small in (0, 4, 64):
        monkeypatch.setattr(lockstep, "SMALL_GROUP", small)
        key, times = lockstep.linked_pairs(a, b, groups, np.array([0, 1]), 10)
        assert dict(zip(key.tolist(), times.tolist())) == want


def test_vocabularies_with_tokens_across_words():
    """Texts are then encoded whole."""
    with open(A_PATH, encoding="utf-8") as one, open(B_PATH, "rb") as other:
        written, model = json.load(one), other.read()
    whole = lockstep.Encoders(json.dumps(written | {"normalizer": {"type": "Lowercase"}}), model)
    assert not whole.by_words
    cut = lockstep.Encoders(json.dumps(written), model)
    assert cut.by_words
    cut.by_words = False
    texts = pa.array([t.encode() for t in TEXTS if t], pa.large_binary())
    again = lockstep.Encoders(json.dumps(written), model).encode(texts)
    assert all(np.array_equal(x, y) for x, y in zip(cut.encode(texts), again))
