from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import seats, sha, shares, simhash_groups, without_repeated_lines, words
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from rotativa.llm import chat_tree, mixing, quality, toxicity
from rotativa.llm.labels import labelled_sample

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id LONG, text STRING, source STRING, size INT, shard INT"
random_ = random.Random(5)

# ------------------------------------------------------------------- mixing


def documents(spark, sizes, sources):
    rows = [(i, None if n is None else "w " * n, s, -1, -1) for i, (n, s) in enumerate(zip(sizes, sources))]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize(
    ("sizes", "sources"),
    [
        ([random_.randrange(0, 900) for _ in range(300)], [random_.choice(["a", "b", "é", "", None, "Z"]) for _ in range(300)]),
        ([5000, 3, 2, 1, 0, None], ["a", "b", "c", "d", "e", "e"]),
        ([200] * 30 + [10], ["a"] * 30 + ["b"]),
        ([0, None], ["a", None]),
        ([10] * 40, ["a"] * 40),
        ([], []),
    ],
)
def test_mix(spark, sizes, sources):
    docs = documents(spark, sizes, sources)
    rows = mixing.mix(mixing.document_sizes(docs), rows_per_shard=40).collect()
    assert len(rows) == len(sizes)
    whole = defaultdict(int)
    for n, s in zip(sizes, sources):
        whole[s] += n or 0
    order = sorted(whole, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = shares({s: whole[s] for s in order}, weights, 3) if sum(whole.values()) else dict.fromkeys(order, 0.0)
    taken = defaultdict(int)
    for r in rows:
        assert r.size == (sizes[r.doc_id] or 0) and r.source_size == whole[r.source]
        assert r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in order:
        # in one shard a source meets its target; several round to blocks each
        assert abs(taken[s] - target[s]) <= (1 if sources.count(s) <= 40 else mixing.BLOCK_WORDS * 1.5)
    again = mixing.mix(mixing.document_sizes(docs.repartition(3)), rows_per_shard=40)
    assert {r.doc_id: r.taken for r in again.collect()} == {r.doc_id: r.taken for r in rows}


@pytest.mark.parametrize("house", [0, 1, 7, 100, 1234])
def test_seats_go_to_the_highest_quotients(spark, house):
    given = [[random_.random() * 10 ** random_.randrange(4) for _ in range(n)] for n in (1, 3, 20)] + [[5.0, 5.0, 5.0, 0.0]]
    rows = spark.createDataFrame([(g, i, s) for g, own in enumerate(given) for i, s in enumerate(own)], "g INT, i INT, share DOUBLE")
    found = mixing.apportion(rows, ["g"], "i", "share", F.lit(house).cast("long"), "won").collect()
    for g, own in enumerate(given):
        assert [r.won for r in sorted(found, key=lambda r: r.i) if r.g == g] == seats(own, house)


def test_mixed_documents_stand_as_often_as_they_are_taken(spark):
    docs = documents(spark, [100] * 60, ["a"] * 5 + ["b"] * 55)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix(mixing.document_sizes(docs)).collect()}
    found = defaultdict(int)
    for r in kept.collect():
        found[r.doc_id] += 1
    assert dict(found) == {i: round(t / 100) for i, t in taken.items() if round(t / 100)}
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_equal_rows_are_mixed_apart(spark):
    docs = spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s")], "doc_id LONG, text STRING, source STRING")
    rows = mixing.mix(mixing.document_sizes(docs), block_words=1).collect()
    assert len(rows) == 4 and sum(r.taken for r in rows) == 8


# ------------------------------------------------------------------- chats

CHAT = "conv_id LONG, turn LONG, role STRING, text STRING, pack INT"
TRICKS = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "<\\|", "<\\\\|end|>", "<", "|", "<|", "", None, "a\nb", "𝄞é" * 40]


@pytest.fixture(scope="module")
def chats():
    made = {}
    openings = [[("system", "be kind"), ("user", t)] for t in ("hello", "hello", TRICKS[1])]
    for i in range(60):
        turns = list(openings[i % 3][: i % 4])
        turns += [(random_.choice(["user", "assistant", None, "a<|", "tool\n"]), random_.choice(TRICKS)) for _ in range(i % 5)]
        if turns:
            made[i] = turns
    made[99], made[100] = made[7], made[7] + [("assistant", "more")]
    made[None] = [("user", "whose?"), ("assistant", "nobody's")]
    return made


def expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    learnt = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(chat_tree.TURN + chat_tree.escape(r) + chat_tree.TEXT + chat_tree.escape(t) + chat_tree.END for r, t in turns)
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt), len(whole)


def rows_of(spark, chats):
    rows = [(c, i, r, t, 3) for c, turns in chats.items() for i, (r, t) in enumerate(turns)]
    random_.shuffle(rows)
    return spark.createDataFrame(rows, CHAT)


def test_chats_read_back(spark, chats):
    formatted = chat_tree.format_conversations(rows_of(spark, chats))
    found = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(formatted).collect()}
    assert found == {c: expected(turns) for c, turns in chats.items()}


@pytest.mark.parametrize("pack_chars", [chat_tree.PACK_CHARS, 3000])
def test_shared_turns_are_written_once_and_seen_by_intervals(spark, chats, tmp_path, pack_chars):
    folder = str(tmp_path / "packs")
    chat_tree.format_conversations(rows_of(spark, chats), pack_chars).write.parquet(folder)
    packs = spark.read.parquet(folder)
    found = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(chat_tree.ordered(packs)).collect()}
    assert found == {c: expected(turns) for c, turns in chats.items()}
    by_pack = defaultdict(list)
    for r in packs.collect():
        by_pack[r.pack].append(r)
    assert (len(by_pack) > 1) == (pack_chars == 3000)
    for rows in by_pack.values():
        stream = "".join(r.text for r in sorted(rows, key=lambda r: r.start) if not r.shared)
        conversations = {r.conv_id for r in rows}
        plain = {c: [(a or "", b or "") for a, b in chats[c]] for c in conversations}
        assert stream.count(chat_tree.TURN) == len({tuple(turns[:n]) for turns in plain.values() for n in range(1, len(turns) + 1)})
        for r in rows:
            assert r.position == sum(s.end - s.start for s in r.context)
            assert all(a.end < b.start for a, b in zip(r.context, r.context[1:])) and all(s.end <= r.start for s in r.context)
            seen = "".join(stream[s.start : s.end] for s in r.context) + stream[r.start : r.end]
            turns = [(chat_tree.unescape(a), chat_tree.unescape(b)) for a, b in chat_tree.TURNS.findall(seen)]
            assert turns == plain[r.conv_id][: r.place + 1]
            learnt = None if r.loss_start is None else chat_tree.unescape(stream[r.loss_start : r.loss_end])
            assert learnt == (turns[-1][1] if turns[-1][0] == "assistant" else None)
    again = {(r.conv_id, r.place): (r.role, r.text, r.learnt) for r in chat_tree.read_turns(packs).collect()}
    assert again == {
        (c, i): (a or "", b or "", (b or "") if a == "assistant" else None) for c, turns in chats.items() for i, (a, b) in enumerate(turns)
    }


def test_conversations_of_very_many_turns(spark):
    """A third of the turns has one id, a third none; two conversations part after 600 shared turns."""
    chats = {1: [("user" if i % 2 else "assistant", f"turn {i}") for i in range(9000)]}
    chats[None] = [("assistant", f"turn {i % 7}") for i in range(9000)]
    chats |= {2: chats[1][:600] + [("user", "a")], 3: chats[1][:600] + [("user", "b" * 300_000)], 4: chats[1][:600]}
    chats |= {c: [("user", str(c)), ("assistant", "yes")] for c in range(10, 3000)}
    formatted = chat_tree.format_conversations(rows_of(spark, chats), 100_000)
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Aggregate" not in plan
    found = {r.conv_id: tuple(r)[1:] for r in chat_tree.read_back(formatted).collect()}
    assert found == {c: expected(turns) for c, turns in chats.items()}


def test_columns_of_other_names_and_repeated_turns(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "x", 5, "k"), (1, 0, "user", "x", 6, "k"), (1, None, None, None, 7, "k")],
        "conv_id LONG, turn LONG, role STRING, text STRING, nth LONG, key STRING",
    )
    found = chat_tree.read_back(chat_tree.format_conversations(rows)).collect()
    assert [tuple(r) for r in found] == [(1, *expected([("", ""), ("user", "x"), ("user", "x")]))]


def test_no_chats(spark):
    assert chat_tree.read_back(chat_tree.format_conversations(spark.createDataFrame([], CHAT))).count() == 0


@pytest.mark.parametrize("text", [t for t in TRICKS if t is not None] + ["<\\\\\\|x", "<<||>>", "\\<|\\|"])
def test_escaping(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    assert not any(mark in chat_tree.escape(text) for mark in (chat_tree.TURN, chat_tree.TEXT, chat_tree.END))


# -------------------------------------------------------------- classifiers


def test_trees_agree_with_a_walk_from_node_to_node():
    random = np.random.default_rng(1)
    values = random.normal(size=(800, 5))
    labels = ((values[:, 0] > 0.3) ^ (values[:, 1] > 0)).astype(float)
    model = quality.fit_trees(values, labels, trees=20)
    raw = []
    for row in values:
        total = model.prior
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        raw.append(total)
    assert np.allclose(model.raw(values), raw)
    assert ((model.score(values) > 0.5) == labels).mean() > 0.97


def test_largest_answers_agree_with_every_window():
    random = np.random.default_rng(2)
    texts = ["one two three four", "", "a", "b c", "x " * 50]
    buckets, numbers, counts = toxicity.word_buckets(pa.array([t.encode() for t in texts], pa.large_binary()))
    filters = [random.normal(size=(w, toxicity.EMBEDDING, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    row_of = np.full(2 * toxicity.BUCKETS, 1)
    row_of[np.unique(buckets)] = np.arange(len(np.unique(buckets))) + 2
    embedding = random.normal(size=(row_of.max() + 1, toxicity.EMBEDDING))
    embedding[0] = 0
    net = toxicity.TextNet(row_of, embedding, filters, [random.normal(size=toxicity.FILTERS) for _ in filters], np.ones(24), 0.0)
    found = net.pooled(buckets, numbers, counts)
    for text, made in zip(np.split(numbers, np.cumsum(counts)[:-1]), found):
        vectors = [embedding[row_of[buckets[w]]].sum(0) for w in text] + [np.zeros(toxicity.EMBEDDING)] * 2
        want = [
            [max(sum(vectors[t + s] @ f[s] for s in range(len(f)))[i] for t in range(len(text))) + b[i] if len(text) else 0 for i in range(toxicity.FILTERS)]
            for f, b in zip(filters, net.bias)
        ]
        assert np.allclose(made, np.maximum(np.concatenate(want), 0), atol=1e-4)


@pytest.fixture(scope="module")
def judged(spark):
    calm = ["the sun is warm today", "we walked along the river", "bread and cheese for lunch"]
    rows, labels = [], []
    for i in range(700):
        bad = i % 4 == 0
        text = " ".join(random_.choice(calm) for _ in range(4))
        text = f"{text} you vile {random_.choice(['vilest', 'vilely'])} thing" if bad else text + " friend"
        rows.append((i, text.upper() + "!!" if i % 5 == 0 else text, random_.choice(["en", "de", None]), "n"))
        labels.append((i, int(i % 5 != 0), int(bad)))
    rows += [(9000, None, "en", "n"), (9001, "", None, "n"), (None, "vile", "xx", "n"), (1, rows[1][1], "en", "n"), (9002, "vile " * 40_000, "en", "n")]
    labels += [(None, 1, 1), (9001, None, None), (5, 0, 7), (8000, 1, 0), (1, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, score STRING")
    return docs, spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_documents(spark, judged, kind):
    docs, labels = judged
    if kind == "quality":
        rows = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    else:
        rows = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()
    truth = {r.doc_id: r[kind] for r in labels.where("doc_id < 700").collect() if r[kind] in (0, 1)}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9


def test_held_out_labels_are_never_read(spark, judged):
    docs, labels = judged
    ids = {r.doc_id for r in labelled_sample(docs, labels, "quality", 4, 2, 100_000).collect()}
    import zlib

    assert ids == {r.doc_id for r in labels.where("doc_id < 700").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert labelled_sample(docs, labels, "quality", 4, 2, 50).select("doc_id").distinct().count() == 50


def test_a_repeated_id_is_one_document_of_the_fit(spark, judged):
    docs, labels = judged
    sampled = labelled_sample(docs, labels, "toxic", 5, 0, 100, ("lang",))
    hot = sampled.select(F.min("doc_id")).first()[0]
    copies = spark.range(10_000).select(F.lit(hot).alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text"))
    columns = ["doc_id", "text", "lang"]
    more = docs.select(columns).unionByName(copies.withColumn("lang", F.lit(None).cast("string")))
    found = labelled_sample(more, labels, "toxic", 5, 0, 100, ("lang",))
    rows = found.collect()
    assert found.columns == sampled.columns and len(rows) == 100
    others = {(r.doc_id, r.text, r.lang, r.label) for r in sampled.collect() if r.doc_id != hot}
    assert others == {(r.doc_id, r.text, r.lang, r.label) for r in rows if r.doc_id != hot}
    again = labelled_sample(more.repartition(7), labels, "toxic", 5, 0, 100, ("lang",))
    assert sorted(again.collect(), key=lambda r: r.doc_id) == sorted(rows, key=lambda r: r.doc_id)


@pytest.mark.parametrize("label", [None, 1])
def test_without_labels_of_both_kinds(spark, judged, label):
    docs, labels = judged
    some = labels.where("doc_id < 40").withColumns({"quality": F.lit(label).cast("int"), "toxic": F.lit(label).cast("int")})
    good = {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, some)).collect()}
    toxic = {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, some)).collect()}
    assert len(good) == len(toxic) == 1 and (good == toxic == {0.5} if label is None else min(good | toxic) > 0.5)
    nothing = docs.limit(0)
    assert quality.score_quality(nothing, quality.fit_quality(nothing, some)).count() == 0
    assert toxicity.score_toxicity(nothing, toxicity.fit_toxicity(nothing, some)).count() == 0


def test_good_documents_keep_their_columns(spark, judged):
    docs, labels = judged
    model = quality.fit_quality(docs, labels)
    kept = quality.good_documents(docs, model)
    passed = quality.score_quality(docs, model).where("predicted = 1").count()
    assert kept.schema == docs.schema and kept.count() == passed


# ----------------------------------------------------------------- pipeline


def test_stages_against_brute_force(spark, tmp_path):
    """Every stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs.orderBy("doc_id").collect()]
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.collect())
        if i < 4:
            assert docs.columns == columns
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    assert len(good - {r.doc_id for r in kept[1]}) <= 1 and len(kept[1]) < len(kept[0])

    before = {r.doc_id: r.text for r in kept[1]}
    after = {r.doc_id: r.text for r in kept[2]}
    # occurrences are ordered as they stand in the stored table
    stood = [r.doc_id for r in kept[1]]
    assert [after[i] for i in stood] == without_repeated_lines([before[i] for i in stood])

    ids = [r.doc_id for r in kept[2]]
    _, sets = simhash_groups([after[i] for i in ids])
    groups = defaultdict(list)
    for place, i in enumerate(ids):
        groups[sets.find(place)].append(i)
    assert sorted(r.doc_id for r in kept[3]) == sorted(min(own) for own in groups.values())

    taken = {r.doc_id: r.taken for r in mixing.mix(mixing.document_sizes(spark.createDataFrame(kept[3], T.StructType(kept_schema(spark))))).collect()}
    copies = defaultdict(int)
    for r in kept[4]:
        copies[r.doc_id] += 1
    sizes = {r.doc_id: len(words(r.text)) for r in kept[3]}
    assert copies == {i: int(t / sizes[i] + 0.5) for i, t in taken.items() if sizes[i] and int(t / sizes[i] + 0.5)}

    assert len(kept[5]) == len(kept[4]) and all(r.round_trip for r in kept[5])


def kept_schema(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").schema.fields


def test_run(spark):
    first = corpus_pipeline.run(spark, FOLDER)
    assert first.count() > 0 and set(first.columns) >= {"doc_id", "tokens"}
