"""Classifier and topic queries.

Hash buckets and fitted coefficients have no SQL counterpart: such queries are
checked by their row counts and by the tests.  What follows from the input
alone (totals of hashed counts, rows and labels of scored texts, the metrics of
a prediction that SQL can state) has an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rotativa.operators import classify, text_features
from rotativa.operators.clean import classifier_rows
from rotativa.plans import classification
from rotativa.queries.base import CLEAN, query, table
from rotativa.queries.rows import headlines
from rotativa.queries.text import STOPPED, texts
from rotativa.session import new_folder, reading, stored
from rotativa.sinks.predictions import PREDICTIONS, PREDICTIONS_WITH_PROBABILITY
from rotativa.sources.headlines import CSV_OPTIONS


def _outputs(spark: SparkSession, folder: str) -> str:
    """Fit and score all headlines; the folder of the three outputs."""
    base = new_folder(spark, "predictions")
    classification.classify_headlines(headlines(spark, folder), base)
    return base


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{_outputs(spark, folder)}/predicciones_parquet")


def _extract(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).csv(f"{_outputs(spark, folder)}/{name}")


def _entries(rows: DataFrame, vector: str) -> DataFrame:
    """The entries of a sparse vector column, one row each."""
    stored = F.unwrap_udt(vector)
    entries = F.zip_with(
        stored["indices"],
        stored["values"],
        lambda bucket, value: F.struct(bucket.alias("bucket"), value.alias("value")),
    )
    return rows.select("enlace", F.inline(entries))


@query("hashing_tf")
def hashing_tf(spark, folder):
    words = text_features.without_stop_words(text_features.with_words(texts(spark, folder)))
    return _entries(text_features.hashed_term_frequencies(words), "rawFeatures")


@query("hashing_tfidf")
def hashing_tfidf(spark, folder):
    return _entries(classify.hashed_tfidf(classification.dealt(texts(spark, folder)), "enlace"), "features")


@query(
    "hashing_tf_totals",
    f"WITH {STOPPED} SELECT enlace, CAST(count(*) AS DOUBLE) AS n FROM stopped GROUP BY enlace",
)
def hashing_tf_totals(spark, folder):
    """Words of each text, out of its hashed counts."""
    entries = hashing_tf(spark, folder)
    return entries.groupBy("enlace").agg(F.sum("value").alias("n"))


@query("ml_predictions")
def ml_predictions(spark, folder):
    return _extract(spark, folder, PREDICTIONS)


@query("ml_predictions_prob")
def ml_predictions_prob(spark, folder):
    return _extract(spark, folder, PREDICTIONS_WITH_PROBABILITY)


@query(
    "scored_label_totals",
    f"""
    WITH {CLEAN}, counts AS (SELECT label, count(*) AS n FROM clean GROUP BY label)
    SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index,
           CAST((SELECT count(*) FROM counts) AS INTEGER) AS classes FROM counts
    """,
)
def scored_label_totals(spark, folder):
    """Rows of each label among the scored texts, its index, and the length of their probability vectors."""
    rows = _predictions(spark, folder)
    classes = F.size(F.unwrap_udt("probability")["values"])
    return rows.groupBy("label").agg(
        F.count("*").alias("n"), F.max("labelIndex").alias("label_index"), F.max(classes).alias("classes")
    )


@query(
    "prediction_vector_text",
    f"WITH {CLEAN} SELECT clean_text, count(*) AS n, CAST((SELECT count(DISTINCT label) FROM clean) AS INTEGER) AS parts FROM clean GROUP BY clean_text",
)
def prediction_vector_text(spark, folder):
    """Rows of each text in the extract with probabilities, and how many numbers their text holds."""
    rows = _extract(spark, folder, PREDICTIONS_WITH_PROBABILITY)
    parts = F.size(F.split("probability_str", ","))
    return rows.groupBy("clean_text").agg(F.count("*").alias("n"), F.max(parts).alias("parts"))


@query("prediction_distribution")
def prediction_distribution(spark, folder):
    return classify.prediction_distribution(_predictions(spark, folder))


@query("ml_confusion")
def ml_confusion(spark, folder):
    """On the held-out rows."""
    return classify.confusion(classification.held_out_predictions(headlines(spark, folder), "enlace")[1])


@query("ml_metrics")
def ml_metrics(spark, folder):
    """On the held-out rows."""
    return classification.evaluate(headlines(spark, folder), "enlace")


HELD_OUT = "CAST('0x' || substr(md5(enlace), 1, 7) AS BIGINT) % 100 < 20"


@query(
    "held_out_split",
    f"WITH {CLEAN} SELECT label, {HELD_OUT} AS held_out, count(*) AS n FROM clean GROUP BY ALL",
)
def held_out_split(spark, folder):
    """Rows of each label on both sides of the split."""
    rows = texts(spark, folder).withColumn("held_out", classification.is_held_out(F.col("enlace")))
    return rows.groupBy("label", "held_out").agg(F.count("*").alias("n"))


@query(
    "held_out_label_totals",
    f"""
    WITH {CLEAN} SELECT label, count(*) AS n, true AS predicted FROM clean WHERE {HELD_OUT} GROUP BY label
    """,
)
def held_out_label_totals(spark, folder):
    """Scored rows of each label: those held out and no others, each with a prediction."""
    _, rows = classification.held_out_predictions(headlines(spark, folder), "enlace")
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.every(F.col("prediction").isNotNull()).alias("predicted"))


# A prediction that SQL can state: the length of a text, against its label's length, in three classes.
RULED = (
    CLEAN
    + """,
ruled AS (
    SELECT CAST(length(label) % 3 AS DOUBLE) + CASE WHEN length(clean_text) % 5 = 0 THEN 1 ELSE 0 END AS labelIndex,
           CAST(length(clean_text) % 4 AS DOUBLE) AS prediction
    FROM clean
)"""
)


def _ruled(spark: SparkSession, folder: str) -> DataFrame:
    shift = F.when(F.length("clean_text") % 5 == 0, 1).otherwise(0)
    return texts(spark, folder).select(
        ((F.length("label") % 3).cast("double") + shift).alias("labelIndex"),
        (F.length("clean_text") % 4).cast("double").alias("prediction"),
    )


@query("rule_distribution", f"WITH {RULED} SELECT prediction, count(*) AS n FROM ruled GROUP BY prediction")
def rule_distribution(spark, folder):
    return classify.prediction_distribution(_ruled(spark, folder))


@query("rule_confusion", f"WITH {RULED} SELECT labelIndex, prediction, count(*) AS n FROM ruled GROUP BY ALL")
def rule_confusion(spark, folder):
    return classify.confusion(_ruled(spark, folder))


@query(
    "rule_metrics",
    f"""
    WITH {RULED},
    actual AS (SELECT labelIndex AS c, count(*) AS a, count(*) FILTER (labelIndex = prediction) AS h FROM ruled GROUP BY 1),
    guessed AS (SELECT prediction AS c, count(*) AS g FROM ruled GROUP BY 1),
    per AS (SELECT a, h, h / a AS r, coalesce(h / g, 0.0) AS p FROM actual LEFT JOIN guessed USING (c)),
    scored AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM per)
    SELECT round(sum(h) / sum(a), 9) AS accuracy, round(sum(p * a) / sum(a), 9) AS precision,
           round(sum(r * a) / sum(a), 9) AS recall, round(sum(f * a) / sum(a), 9) AS f1
    FROM scored
    """,
)
def rule_metrics(spark, folder):
    metrics = classify.quality_metrics(classify.confusion(_ruled(spark, folder)))
    return metrics.select(*(F.round(name, 9).alias(name) for name in metrics.columns))


def _topics(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(classification.dealt(texts(spark, folder)), "texts")
    return reading(classification.fitted(classify.topic_model(), rows).transform(rows), rows)


@query("topic_clusters")
def topic_clusters(spark, folder):
    return _topics(spark, folder).groupBy("topic").agg(F.count("*").alias("n"))


@query("topic_rows", f"WITH {CLEAN} SELECT label, count(*) AS n, true AS in_range FROM clean GROUP BY label")
def topic_rows(spark, folder):
    """Rows of each label that got a topic, and whether all are one of the eight."""
    rows = _topics(spark, folder).where(F.col("topic").isNotNull())
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.every(F.col("topic").between(0, 7)).alias("in_range"))


@query(
    "topic_term_totals",
    "SELECT CAST(topic AS INTEGER) AS topic, CAST(10 AS BIGINT) AS terms, true AS known, true AS falling FROM range(8) t(topic)",
)
def topic_term_totals(spark, folder):
    """Topics by their words: how many each has, whether all occur in two texts or more, and whether weights fall by rank."""
    rows = stored(classification.dealt(texts(spark, folder)), "texts")
    terms = classify.topic_terms(classification.fitted_topics(classify.named_topics(), rows))
    # cleaned texts hold no white space but the space
    named = F.broadcast(terms.select("term").distinct())  # ten a topic
    words = rows.select(F.explode(F.array_distinct(F.split("clean_text", " "))).alias("term")).join(named, "term")
    words = words.groupBy("term").agg(F.count("*").alias("texts"))
    found = terms.join(words, "term", "left").groupBy("topic")
    pairs = F.array_sort(F.collect_list(F.struct("rank", "weight")))  # ten a topic
    return found.agg(F.count("*").alias("terms"), F.every(F.coalesce(F.col("texts") >= 2, F.lit(False))).alias("known"), pairs.alias("p")).select(
        "topic", "terms", "known", F.forall(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get("p", i - 1)["weight"] >= F.get("p", i)["weight"]).alias("falling")
    )


def _label_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The same classifier with another label, fitted on the labelled documents and applied to all."""
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    model, _ = classification.train(documents.join(labels, "doc_id"), "doc_id", label="quality", text="text")
    unlabelled = documents.withColumn("quality", F.lit(""))
    rows = classifier_rows(unlabelled, "doc_id", label="quality", text="text", drop_empty=False)
    return classify.with_top_probability(classify.score(classify.for_scoring(model), rows))


@query("label_classifier")
def label_classifier(spark, folder):
    return _label_scores(spark, folder).select("doc_id", "prediction", "top_probability")


@query("label_classifier_rows", "SELECT doc_id, true AS scored FROM documents")
def label_classifier_rows(spark, folder):
    """Every document has a prediction and a probability."""
    scored = F.col("prediction").isNotNull() & F.col("top_probability").between(0.0, 1.0)
    return _label_scores(spark, folder).select("doc_id", scored.alias("scored"))
