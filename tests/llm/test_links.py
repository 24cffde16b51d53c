from __future__ import annotations

import random

import numpy as np
import pytest
from brute import Sets, fingerprint, simhash_groups, without_repeated_lines
from pyspark.sql import functions as F

from rotativa.llm import cover_tree, golay, hnsw, line_dedup
from rotativa.llm.components import components

random_ = random.Random(11)
WORDS = [f"w{i:03}" for i in range(300)] + ["the", "of", "a", "und", "été"]


def sentence(count):
    return " ".join(random_.choice(WORDS) for _ in range(count))


def edited(text):
    words = text.split(" ")
    words[random_.randrange(len(words))] = "changed"
    return " ".join(words)


# ---------------------------------------------------------------- components


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 1)],
        [(i, i + 1) for i in range(40)],
        [(0, i) for i in range(1, 60)] + [(100, i) for i in range(101, 140)],
        [(random_.randrange(80), random_.randrange(80)) for _ in range(60)],
    ],
)
def test_components(spark, links):
    sets = Sets({x for link in links for x in link})
    for a, b in links:
        sets.join(a, b)
    given = spark.createDataFrame([*links, *links, (None, 3), (2, None)], "a LONG, b LONG")
    found = {r.node: r.component for r in components(given).collect()}
    assert found == {x: sets.find(x) for x in sets.name}


# ------------------------------------------------------------- fingerprints


def test_golay_code():
    table, count = golay.error_table()
    assert sorted(set(count.tolist())) == [1, 6]
    assert (golay.syndromes(table[np.arange(2048)[count == 6]][:, 0]) == np.flatnonzero(count == 6)).all()


@pytest.mark.parametrize("apart", [0, 1, 2])
def test_fingerprints_within_two_bits_share_a_key(apart):
    random = np.random.default_rng(apart)
    first = random.integers(-(2**63), 2**63 - 1, 800)
    second = first.copy()
    for i in range(len(second)):
        for bit in random.choice(64, apart, replace=False):
            second[i] ^= np.int64(np.uint64(1) << np.uint64(bit))
    keys = [set(zip(*(x.tolist() for x in golay.keys(v)))) for v in (first, second)]
    assert {row for row, _ in keys[0] & keys[1]} == set(range(800))


@pytest.fixture(scope="module")
def texts():
    base = [sentence(n) for n in (1, 2, 3, 5, 30, 80, 200, 200, 400)]
    near = [edited(t) for t in base[5:] for _ in range(4)]
    return [*base, *base, *near, "", None, "  \t\n", "A B\tC", "a  b c", "x" * 30_000, sentence(30_000), *["same text again"] * 30]


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_groups(spark, texts, bucket, monkeypatch):
    monkeypatch.setattr(golay, "BUCKET_ROWS", bucket)
    rows = spark.createDataFrame([(i + 5, t, i) for i, t in enumerate(texts)], "doc_id LONG, text STRING, fingerprint INT")
    prints, sets = simhash_groups(texts)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in golay.near_duplicates(rows).collect()}
    assert found == {i + 5: (f"{p:016x}", sets.find(i) + 5) for i, p in enumerate(prints)}
    kept = golay.one_per_group(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({sets.find(i) + 5 for i in range(len(texts))})


def test_simhash_without_ids_and_rows(spark):
    rows = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "q")], "doc_id LONG, text STRING")
    found = sorted(((r.doc_id, r.component_id) for r in golay.near_duplicates(rows).collect()), key=repr)
    assert found == sorted([(3, 3), (3, 3), (None, 3), (None, 3), (None, None)], key=repr)
    assert golay.one_per_group(rows).count() == 2
    assert golay.near_duplicates(rows.limit(0)).count() == golay.one_per_group(rows.limit(0)).count() == 0
    assert fingerprint("a b c") == golay.fingerprint(b"a b c")


# -------------------------------------------------------------------- lines


def lines_of(spark, texts, **more):
    rows = [(i, t, "kept", i * 2, -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, dropped STRING, _row INT, n_chars LONG").coalesce(1)


def test_lines(spark):
    base = [sentence(n) for n in (1, 2, 6, 12, 40, 60, 60)]
    texts = [
        "\n".join(base),
        "\n".join([edited(base[5]), "own line here", edited(base[6]), base[0].upper() + " !!"]),
        None,
        "",
        "\n\n---\n" + base[3],
        "---\n***\n12",
        base[4] + "\n" + base[4] + "\r\n  " + base[4] + "  ",
        "\n".join(edited(base[5]) for _ in range(12)),
        "\n".join(base),
    ]
    docs = lines_of(spark, texts)
    found = line_dedup.deduplicated(docs)
    assert found.columns == docs.columns
    rows = {r.doc_id: r for r in found.collect()}
    assert [rows[i].text for i in range(len(texts))] == without_repeated_lines(texts)
    assert all(r.dropped == "kept" and r._row == 2 * i for i, r in rows.items())
    assert rows[0].n_chars == len(rows[0].text) and rows[2].n_chars is None


def test_equal_documents_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "one two\nthree"), (1, "one two\nthree"), (None, "one two")], "doc_id LONG, text STRING").coalesce(1)
    assert sorted(r.text for r in line_dedup.deduplicated(docs).collect()) == ["", "", "one two\nthree"]
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ vectors


def vectors_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id LONG, embedding ARRAY<{kind}>, n_links INT")


@pytest.fixture(scope="module")
def points():
    random = np.random.default_rng(3)
    centres = random.normal(size=(12, 16))
    near = [c + random.normal(scale=s, size=16) for c in centres for s in (0, 0, 0.05, 0.2, 0.3, 0.45)]
    made = [*near, *random.normal(size=(60, 16)), *[centres[0] * 3] * 20]
    return [list(map(float, np.float32(v))) for v in made]


@pytest.mark.parametrize(("block", "pivots"), [(8192, 256), (30, 4), (1, 1)])
def test_all_links_above_the_cosine(spark, points, block, pivots):
    points = points[:: 4 if block == 1 else 1]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (904, [1.0, 2.0]), (905, [2.0, 4.0]), (906, [])]
    rows = [*((i, p, 7) for i, p in enumerate(points)), *((i, p, None) for i, p in odd)]
    given = vectors_of(spark, rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(given, "vec_id", "embedding", 0.9, block, pivots).collect()}
    v = np.array(points)
    cosine = (v @ v.T) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    linked = (cosine >= 0.9) & ~np.eye(len(v), dtype=bool)
    sets = Sets(range(len(v)))
    for a, b in zip(*np.nonzero(linked)):
        sets.join(int(a), int(b))
    expected = {i: (int(linked[i].sum()), sets.find(i), sets.find(i) == i) for i in range(len(v))}
    expected |= {i: (0, i, True) for i, _ in odd} | {904: (1, 904, True), 905: (1, 904, False)}
    assert found == expected


def test_links_of_repeated_and_missing_ids(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)]
    found = sorted(map(tuple, cover_tree.near_duplicates(vectors_of(spark, rows, "double"), "vec_id", "embedding").collect()), key=repr)
    assert found == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (None, 0, None, True)], key=repr)
    assert cover_tree.near_duplicates(vectors_of(spark, []), "vec_id", "embedding").count() == 0


def test_a_tree_covers_its_points():
    from rotativa.llm.vectors import unit

    points = unit(np.random.default_rng(4).normal(size=(300, 5)))
    tree = cover_tree.build_tree(points)
    assert sorted(tree.order.tolist()) == list(range(300))
    ordered = points[tree.order]
    reach = [(i, i + 1) for i in range(300)]
    for level, below in zip(tree.levels[-2::-1], tree.levels[::-1]):
        reach = [(reach[a][0], reach[b - 1][1]) for a, b in zip(level.first, level.last)]
        assert [x for pair in reach for x in range(*pair)] == list(range(300))
        for (a, b), centre, radius in zip(reach, level.centre, level.radius):
            assert np.linalg.norm(ordered[a:b] - ordered[centre], axis=1).max() <= radius + 1e-6
        assert set(level.centre) <= set(below.centre)


def test_nearest(spark):
    random = np.random.default_rng(8)
    points = np.float32(random.normal(size=(1500, 24)))
    points[700:760] = points[100]
    rows = [(i, list(map(float, p)), 1) for i, p in enumerate(points)]
    rows += [(5000, None, 1), (5050, [0.0] * 24, 1), (5100, [float("inf")] + [1.0] * 23, 1), (None, rows[3][1], 1), (6000, [1.0, 1.0], 1)]
    given = vectors_of(spark, rows)
    index = hnsw.build_index(given, "vec_id", "embedding", 6, shard_values=400 * 24)
    assert index.count() > 3
    queries = given.where("vec_id % 50 = 0").where("vec_id < 1500 OR vec_id = 6000").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    found = {}
    for r in hnsw.search(index, queries, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    v = points.astype(float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    assert sorted(found) == list(range(0, 1500, 50))
    for i, answers in found.items():
        score = unit @ unit[i]
        score[i] = -2
        score = score.round(12)
        best = np.lexsort((np.arange(1500), -score))[:5]
        assert len({a for a, _ in answers}) == 5 and i not in {a for a, _ in answers}
        assert all(s == pytest.approx(score[a], abs=1e-11) for a, s in answers)
        hits += len({a for a, _ in answers} & set(best.tolist()))
    assert hits >= 0.9 * 5 * len(found)
    assert [a for a, _ in found[100]] == [700, 701, 702, 703, 704]


def test_nearest_among_few(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (50, [0.0, 1.0], 1), (50, [0.0, 1.0], 1)]
    found = hnsw.nearest(vectors_of(spark, rows), "vec_id", "embedding", every=50).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert hnsw.nearest(vectors_of(spark, []), "vec_id", "embedding", every=50).count() == 0
