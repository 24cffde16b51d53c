from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import functions as F

from rotativa.operators import classify, text_features
from rotativa.operators.clean import classifier_rows
from rotativa.plans import classification
from rotativa.sources.headlines import CSV_OPTIONS
from rotativa.sinks.predictions import ALL_COLUMNS, PREDICTIONS, PREDICTIONS_WITH_PROBABILITY, save_predictions_by_day

TITLES = [
    ("Política", "Votan la ley de aguas en el congreso"),
    ("Política", "El congreso vota la ley de paz"),
    ("Política", "El congreso discute otra ley de aguas"),
    ("Deportes", "Tunja gana la carrera de montaña"),
    ("Deportes", "Gana la copa el club de montaña"),
    ("Economía", "Sube el café en el mercado"),
    ("Economía", "El mercado espera café más caro"),
    (None, "Sin categoría conocida"),
    ("Deportes", "12345"),
    ("Deportes", None),
]


@pytest.fixture(scope="module")
def headlines(spark):
    rows = [(c, t, f"/{i}", "2024", "01", f"{i % 3 + 1:02d}") for i, (c, t) in enumerate(TITLES)]
    return spark.createDataFrame(rows, "categoria STRING, titular STRING, enlace STRING, year STRING, month STRING, day STRING")


@pytest.fixture(scope="module")
def trained(headlines):
    return classification.train(headlines, "year", "month", "day", num_features=256)


def test_classifier_rows(headlines):
    assert classifier_rows(headlines).count() == 7
    assert classifier_rows(headlines, drop_empty=False).count() == 8


def test_words_and_stop_words(spark):
    rows = spark.createDataFrame([(1, "the ley  de paz "), (2, "   "), (3, " x")], "id INT, clean_text STRING")
    words = text_features.without_stop_words(text_features.with_words(rows)).orderBy("id").collect()
    assert [r.words for r in words] == [["the", "ley", "", "de", "paz"], [], ["", "x"]]
    assert words[0].filtered_words == ["ley", "", "de", "paz"]
    spanish = text_features.without_stop_words(text_features.with_words(rows), language="spanish").orderBy("id").first()
    assert spanish.filtered_words == ["the", "ley", "", "paz"]


def test_hashed_frequencies_hold_every_word(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["c"])], "id INT, filtered_words ARRAY<STRING>")
    hashed = text_features.hashed_term_frequencies(rows, 64).orderBy("id").collect()
    assert [sum(r.rawFeatures.values) for r in hashed] == [3.0, 0.0, 1.0]
    assert sorted(hashed[0].rawFeatures.values) == [1.0, 2.0] and hashed[0].rawFeatures.size == 64


def test_tfidf_terms_against_counting(spark):
    texts = {f"k{i}": [f"w{j}" for j in range(40) if (i * j) % 7 == 0] * (1 + i % 2) + (["a" * 300] if i % 3 == 0 else []) for i in range(60)}
    texts["empty"] = []
    rows = spark.createDataFrame(list(texts.items()), "key STRING, words ARRAY<STRING>")
    df = Counter(term for words in texts.values() for term in set(words))
    expected = {
        (key, term): (tf, df[term], round(tf * math.log((len(texts) + 1) / (df[term] + 1)), 6))
        for key, words in texts.items()
        for term, tf in Counter(words).items()
    }
    found = text_features.tfidf_terms(rows, "key").collect()
    assert {(r.key, r.term): (r.tf, r.df, r.tfidf) for r in found} == expected
    assert len(found) == len(expected)


def test_very_many_labels_are_ranked(spark):
    rows = spark.range(25_000).select(F.concat(F.lit("l"), F.pmod(F.col("id") * 7, F.lit(12_000)).cast("string")).alias("label"))
    counts = Counter(r.label for r in rows.collect())
    ranked = text_features.label_index(rows).orderBy("label_index").collect()
    assert [(r.label, r.n) for r in ranked] == sorted(counts.items(), key=lambda item: (-item[1], item[0]))
    assert [r.label_index for r in ranked] == list(range(12_000))


def test_label_index_equals_the_indexer(spark):
    rows = spark.createDataFrame([(label,) for label in "bbaaccccd"] + [(None,)], "label STRING")
    model = StringIndexer(inputCol="label", outputCol="i").fit(rows.na.drop())
    ranked = text_features.label_index(rows).orderBy("label_index").collect()
    assert [r.label for r in ranked] == list(model.labels) == ["c", "a", "b", "d"]


def test_training_scores_every_row(trained):
    model, predictions = trained
    rows = classify.with_top_probability(predictions).collect()
    assert len(rows) == 7
    for row in rows:
        assert abs(sum(row.probability) - 1) < 1e-9
        assert row.top_probability == max(row.probability)
    assert list(model.stages[4].labels) == ["Política", "Deportes", "Economía"]
    assert classify.prediction_distribution(predictions).agg(F.sum("n")).first()[0] == 7


def test_metrics_equal_the_evaluator(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 0.0)] + [(2.0, 0.0)] * 2 + [(1.0, 3.0)]
    rows = spark.createDataFrame(pairs, "labelIndex DOUBLE, prediction DOUBLE")
    metrics = classify.quality_metrics(classify.confusion(rows)).first().asDict()
    for ours, theirs in [("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")]:
        evaluator = MulticlassClassificationEvaluator(labelCol="labelIndex", predictionCol="prediction", metricName=theirs)
        assert metrics[ours] == pytest.approx(evaluator.evaluate(rows))


def test_stored_outputs(spark, headlines, tmp_path):
    base, model_path = str(tmp_path / "out"), str(tmp_path / "model")
    stored = classification.classify_headlines(headlines, base, model_path, num_features=256)
    assert stored.count() == 7
    assert {"clean_text", "label", "words", "filtered_words", "rawFeatures", "features", "labelIndex", "probability", "prediction"} <= set(
        spark.read.parquet(f"{base}/{ALL_COLUMNS}").columns
    )
    plain = spark.read.options(**CSV_OPTIONS).csv(f"{base}/{PREDICTIONS}")
    assert plain.columns == ["clean_text", "label", "prediction"] and plain.count() == 7
    detailed = spark.read.options(**CSV_OPTIONS).csv(f"{base}/{PREDICTIONS_WITH_PROBABILITY}")
    assert detailed.columns == ["clean_text", "label", "prediction", "probability_str"]
    assert detailed.first().probability_str.startswith("[")

    again = classify.score(PipelineModel.load(model_path), classifier_rows(headlines))
    pick = ["clean_text", "prediction"]
    assert sorted(map(tuple, again.select(*pick).collect())) == sorted(map(tuple, stored.select(*pick).collect()))


def test_predictions_by_day(spark, trained, tmp_path):
    _, predictions = trained
    out = str(tmp_path / "by-day")
    save_predictions_by_day(predictions.select("clean_text", "prediction", "year", "month", "day"), out)
    save_predictions_by_day(predictions.select("clean_text", "prediction", "year", "month", "day"), out)
    assert spark.read.parquet(out).count() == 7
    assert {p.name for p in (tmp_path / "by-day/year=2024/month=01").iterdir() if p.is_dir()} == {"day=01", "day=02", "day=03"}


def test_topics(headlines):
    rows = classifier_rows(headlines)
    topics = classify.topic_model(topics=2, num_features=256).fit(rows).transform(rows)
    assert topics.groupBy("topic").count().agg(F.sum("count")).first()[0] == 7


def test_held_out_rows_are_not_fitted_on(spark):
    rows = [(f"/{i}", "A" if i % 3 else "B", f"{'sol playa' if i % 3 else 'gol equipo'} palabra{i % 11}") for i in range(300)]
    held_key = next(f"/x{i}" for i in range(1000) if spark.range(1).select(classification.is_held_out(F.lit(f"/x{i}"))).first()[0])
    rows += [(held_key, "solo", "sol gol nunca vista"), (None, "A", "sol playa")]
    headlines = spark.createDataFrame(rows, "enlace STRING, categoria STRING, titular STRING")
    split = lambda frame: {r.enlace for r in frame.where(classification.is_held_out(F.col("enlace"))).collect()}
    assert split(headlines) == split(headlines.repartition(7)) and None not in split(headlines)
    assert 30 <= len(split(headlines)) <= 90

    model, predictions = classification.held_out_predictions(headlines, "enlace", num_features=256)
    found = predictions.collect()
    assert {r.enlace for r in found} == split(headlines)
    labels = next(s for s in model.stages if hasattr(s, "labels")).labels
    assert set(labels) == {"A", "B"}  # the label that only a held-out row has is unknown, and no error
    assert sum(r.labelIndex == r.prediction for r in found) == len(found) - 1
    metrics = classification.evaluate(headlines, "enlace", num_features=256).first()
    assert metrics.accuracy == pytest.approx((len(found) - 1) / len(found))


def test_fits_do_not_inherit_the_files(spark):
    one = spark.range(1000).coalesce(1)
    parts = classification.dealt(one).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 300


def test_topics_have_words(spark):
    rows = [("l", f"{'gol equipo partido' if i % 2 else 'voto senado ley'} palabra{i % 7}") for i in range(60)] + [("l", "unica"), ("l", " ")]
    texts = spark.createDataFrame(rows, "label STRING, clean_text STRING")
    model = classify.named_topics(topics=2, max_iterations=20).fit(texts)
    terms = classify.topic_terms(model, 3).collect()
    assert {t: {r.term for r in terms if r.topic == t} for t in (0, 1)}.values() and all(r.rank in (1, 2, 3) for r in terms)
    assert {frozenset(r.term for r in terms if r.topic == t) for t in (0, 1)} == {frozenset(("gol", "equipo", "partido")), frozenset(("voto", "senado", "ley"))}
    scored = classify.main_topic(model.transform(texts)).collect()
    assert {r.topic for r in scored if "gol" in r.clean_text} != {r.topic for r in scored if "voto" in r.clean_text}
    assert [r.topic for r in scored if r.clean_text in ("unica", " ")] == [None, None]


def test_more_text_is_dealt_to_more_parts(spark, monkeypatch):
    """A part does not grow with the input, and all tasks are busy to the end."""
    monkeypatch.setattr(classification, "PART_BYTES", 256 << 10, raising=False)
    tasks = spark.sparkContext.defaultParallelism
    for n in (2_000, 20_000, 80_000):
        rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("clean_text"), F.lit(None).cast("string").alias("label"))
        parts = [part["count"] for part in classification.dealt(rows).groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(parts) == n and len(parts) % tasks == 0 and max(parts) * 64 <= 1.1 * (256 << 10)
    assert classification.dealt(spark.createDataFrame([], "clean_text STRING")).count() == 0


def test_a_fit_reads_bounded_parts(spark, monkeypatch, tmp_path):
    """Files that a scan would put together are read apart while a fit lasts, and only then."""
    monkeypatch.setattr(classification, "PART_BYTES", 4 << 20, raising=False)
    path, parts = str(tmp_path / "rows"), []
    spark.range(64).repartition(32).write.parquet(path)
    rows = spark.read.parquet(path)

    class Counting:
        def fit(self, rows):
            parts.append(rows.rdd.getNumPartitions())

    classification.fitted(Counting(), rows)
    assert parts == [32] and spark.read.parquet(path).rdd.getNumPartitions() < 32


def _read_columns(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"(\w+)#\d+", re.search(r"FileScan parquet \[([^\]]*)\]", plan)[1]))


def test_scores_start_from_stored_counts(headlines):
    _, scored = classification.train(headlines, num_features=256)
    _, held_out = classification.held_out_predictions(headlines, "enlace", num_features=256)
    assert _read_columns(scored.select("prediction")) == {"rawFeatures"}
    assert _read_columns(held_out.select("prediction")) == {"rawFeatures", "held_out"}
    assert {"words", "filtered_words", "features", "labelIndex", "clean_text", "enlace"} <= set(held_out.columns)


def test_options_reach_the_held_out_classifier(headlines):
    model, scored = classification.held_out_predictions(headlines, "enlace", num_features=64)
    assert model.stages[3].idf.size == 64 and scored.where("size(words) = 0").count() == 0


def test_topics_are_fitted_on_stored_words(spark, monkeypatch):
    texts = spark.createDataFrame([(f"uno dos tres w{i % 5}",) for i in range(40)], "clean_text STRING")
    read = []
    fitted = classification.fitted
    monkeypatch.setattr(classification, "fitted", lambda pipeline, rows: read.append(rows.columns) or fitted(pipeline, rows))
    model = classification.fitted_topics(classify.named_topics(topics=2, max_iterations=2), texts)
    assert read == [["filtered_words"]]
    assert {row.term for row in classify.topic_terms(model).collect()} == {"uno", "dos", "tres", "w0", "w1", "w2", "w3", "w4"}
    assert classify.main_topic(model.transform(texts)).where("topic IS NULL").count() == 0


def test_vocabulary_equals_the_counter(spark):
    rows = spark.createDataFrame([(["a"] * 5,), (["b", "c", "b"],), (["b", "c"],), ([],), (["d", "c", "b", "e"],), (["e"],)], "words ARRAY<STRING>")
    model = CountVectorizer(inputCol="words", outputCol="counts", vocabSize=3, minDF=2).fit(rows)
    assert text_features.vocabulary(rows, "words", 3, 2) == list(model.vocabulary) == ["b", "c", "e"]
