"""The toxicity fit: every labelled document takes part, in one shard or in many."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from rotativa.llm import toxicity


MILD = ["kind", "dear", "good", "old"]


@pytest.fixture(scope="module")
def judged(spark):
    """Toxic words that the 150 ids of the smallest hashes have not."""
    random_ = random.Random(3)
    calm = ["the sun is warm today", "we walked along the river", "bread and cheese for lunch", "snow fell over the hills"]
    ids = [r.id for r in spark.range(900).orderBy(F.xxhash64("id"), "id").collect()]
    early = set([i for i in ids if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT][:150])
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        word = random_.choice(["nasty", "horrid"] if i in early else ["vile", "wicked"])
        rows.append((i, " ".join(random_.choice(calm) for _ in range(3)) + f" my {word if bad else random_.choice(MILD)} friend", random_.choice(["en", "de", None])))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    return docs, spark.createDataFrame(labels, "doc_id LONG, toxic INT")


def test_documents_beyond_a_shard_are_learnt_from(spark, judged):
    docs, labels = judged
    net = toxicity.fit_toxicity(docs, labels, 150)
    rows = toxicity.score_toxicity(docs.where(F.col("text").rlike("vile|wicked|kind|dear")), net).where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.predicted == (r.doc_id % 3 == 0) for r in rows]) > 0.95


@pytest.mark.parametrize("parts", [1, 5])
def test_shards_hold_every_document_once(spark, judged, parts):
    docs, _ = judged
    hashed = docs.withColumn("label", F.lit(1)).mapInArrow(
        toxicity._hashed, "doc_id BIGINT, label INT, lang STRING, place BIGINT, size BIGINT, words ARRAY<INT>"
    )
    held, words, seen = 0, 0, 0
    for part in range(parts):
        own = hashed.where(F.col("place") % parts == part).toArrow()
        shard = next(toxicity._shards(toxicity._packed((own.column("size")[0],), own).to_batches()))
        held += len(shard["learn_labels"]) + len(shard["watch_labels"])
        words += len(shard["learn_words"]) + len(shard["watch_words"])
        assert len(shard["learn_words"]) == shard["learn_sizes"].sum() and len(shard["watch_langs"]) == len(shard["watch_sizes"])
        seen += shard["seen_docs"].sum()
    texts = [r.text.split() for r in docs.collect()]
    assert held == 900 and words == sum(map(len, texts))
    both = [{b for pair in toxicity.word_buckets(toxicity.pa.array([t.encode()], toxicity.pa.large_binary()))[0] for b in pair} for t in map(" ".join, texts)]
    assert seen == sum(map(len, both))


def test_gradients_agree_with_differences():
    random_ = np.random.default_rng(4)
    parameters = toxicity.Parameters(random_.normal(size=(9 + toxicity.OTHER_UNITS, toxicity.EMBEDDING)))
    parameters.embedding[toxicity.PAD] = 0
    counts, labels = np.array([5, 1, 3]), np.array([1, 0, 1])
    rows = random_.integers(1, 9, (9, 2))

    def loss():
        net = toxicity.TextNet(np.arange(9), parameters.embedding, parameters.filters, parameters.bias, parameters.weight, parameters.intercept[0])
        chance = net.score(rows, np.arange(9), counts)
        return -np.sum(np.where(labels == 1, np.log(chance), np.log(1 - chance)))

    at, gradient = toxicity._gradient(rows, counts, labels, parameters)
    made = np.zeros_like(parameters.table)
    made[at] = gradient
    table = parameters.table
    for i in range(1, len(table)):
        for j in range(toxicity.EMBEDDING):
            held = table[i, j]
            table[i, j] = held + 1e-3
            up = loss()
            table[i, j] = held - 1e-3
            assert abs((up - loss()) / 2e-3 - made[i, j]) < 2e-2 * max(1, abs(made[i, j]))
            table[i, j] = held


def test_thresholds_agree_with_every_cut():
    random_ = np.random.default_rng(6)
    chance, labels = random_.integers(0, 40, 300) / 40, (random_.random(300) < 0.3).astype(float)
    langs = [random_.choice(["en", "de", "fr"]) if i % 4 else None for i in range(300)]
    found = toxicity.calibrated(chance, labels, langs)
    for lang, cut in found.items():
        own = np.array([one == lang for one in langs])
        c, y = chance[own], labels[own]
        f1 = {x: 2 * ((c >= x) & (y == 1)).sum() / ((c >= x).sum() + y.sum()) for x in [*c.tolist(), 0.5]}
        assert f1[cut] == max(f1.values()) and abs(cut - 0.5) == min(abs(x - 0.5) for x in f1 if f1[x] == f1[cut])
    assert set(found) == {"en", "de", "fr", None}
