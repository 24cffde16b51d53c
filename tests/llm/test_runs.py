"""Runs of repeated words against trying every period, and the query's digests against the contract in plain Python."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from brute import sha, words
from pyspark.sql import functions as F

from rotativa.llm import runs
from rotativa.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def every_run(items: list, exponent: int, length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) by comparing the items at every distance."""
    found: dict[tuple[int, int], int] = {}
    codes = np.unique(np.array(items), return_inverse=True)[1] if len(items) else np.zeros(0)
    for period in range(1, len(items) // exponent + 1):
        same = np.concatenate(([0], codes[period:] == codes[:-period], [0])).astype(int)
        change = np.diff(same)
        for x, y in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if y - x + period >= max(length, exponent * period):
                found.setdefault((x, y + period), period)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def caught(texts: list[list[int]], exponent: int, length: int) -> list[list[tuple[int, int, int]]]:
    counts = np.array([len(t) for t in texts], np.int64)
    flat = np.array([x for t in texts for x in t], np.int64)
    made = [[] for _ in texts]
    begins = np.cumsum(counts) - counts
    for first, end, period in zip(*(x.tolist() for x in runs.Catchers(flat, counts, exponent, length).runs())):
        text = int(np.searchsorted(np.cumsum(counts), first, side="right"))
        made[text].append((first - int(begins[text]), end - first, period))
    return made


@pytest.mark.parametrize(("exponent", "length"), [(2, 2), (3, 5), (4, 6)])
def test_against_every_period(exponent, length):
    random_ = random.Random(exponent)
    for _ in range(400):
        texts = []
        for _ in range(random_.randint(0, 6)):
            n, kinds = random_.randint(0, 70), random_.randint(1, 4)
            items = [random_.randrange(kinds) for _ in range(n)]
            if n and random_.random() < 0.5:
                a = random_.randrange(n)
                p = random_.randint(1, max(1, (n - a) // 2))
                items = [items[i] if i < a else items[a + (i - a) % p] for i in range(n)]
            texts.append(items)
        found = [sorted(r, key=lambda r: (r[0], r[2])) for r in caught(texts, exponent, length)]
        assert found == [sorted(every_run(t, exponent, length), key=lambda r: (r[0], r[2])) for t in texts]


def test_long_texts_stay_cheap():
    """One word, two words by Fibonacci's rule (very many runs), and a long period."""
    one = [0] * 60_000
    a, b = [1], [0]
    while len(b) < 3_000:
        a, b = b, b + a
    wide = list(range(7_001)) * 5
    first, second, third = caught([one, b, wide], 4, 6)
    assert first == [(0, 60_000, 1)] and third == [(0, 35_005, 7_001)]
    assert second == every_run(b, 4, 6)
    assert sorted(caught([b], 2, 2)[0]) == every_run(b, 2, 2)


def plain(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted(every_run(w, 4, 6), key=lambda r: (r[0], r[2]))
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (
        doc_id, len(found), *best, milli,
        sha("".join(f"{s},{l},{q}\n" for s, l, q in found)),
        sha(b" ".join(x for i, x in enumerate(w) if i not in gone).decode()),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark):
    got = QUERIES["op13_word_runs"](spark, FOLDER)
    assert got.columns == COLUMNS
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, got.collect()))
    assert found == sorted(plain(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in found) > 3


def test_edges(spark):
    """NULLs, no words, other spaces, repeated rows, clashing names, one word 50,000 times, text beyond the first plane."""
    rows = [
        (1, None, 5), (2, "", 5), (2, "", 5), (None, "a b " * 9, 5), (None, None, None), (3, " \t\x0b\n ", 5), (4, "x y " * 8, 5),
        (5, "😀 é é " * 7 + "😀", 5), (6, "go " * 20_000, 5), (7, "a b a b a b a b a b c c c c c c", 5), (18, "w " * 40, 5),
    ]
    rows += [(i, "one two three four five six seven eight nine ten eleven twelve", 0) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_words INT")
    clashing = docs.withColumnsRenamed({"n_words": "runs"}).withColumn("period", F.lit(1))
    got = runs.run_digests(runs.word_runs(clashing.withColumn("text", runs.planted(F.col("text"), F.col("doc_id"))), ("doc_id",)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain(r[0], r[1]) for r in rows), key=key)
    assert runs.word_runs(docs.limit(0), ("doc_id",)).count() == 0
    kept = runs.word_runs(docs.where("doc_id = 7"), ("doc_id",)).first()
    assert [tuple(r) for r in kept.runs] == [(0, 10, 2), (10, 6, 1)] and kept.collapsed == "a b c"
