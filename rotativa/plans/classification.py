"""Headline rows to a fitted classifier, its quality on rows it has not seen, and stored predictions."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizerModel, StringIndexer
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, functions as F

from rotativa.operators.classify import confusion, hashing_stages, logistic_regression, quality_metrics, score, text_classifier, word_stages
from rotativa.operators.clean import classifier_rows
from rotativa.operators.text_features import vocabulary
from rotativa.session import discard, read_in_parts, reading, stored
from rotativa.sinks.predictions import save_predictions

PART_BYTES = 16 << 20  # of text; vectors made of it take several times as much
HELD_OUT_PERCENT = 20
REGULARISATIONS = (0.0, 0.01, 0.1)


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in equal parts: one for each task the cluster runs at a time, or several of at most ``PART_BYTES`` of text.

    A fit reads its rows many times, so it must not inherit the layout of the files
    they come from, which may be one.  Rows go round, so no frequent text or label
    makes a part larger; of a larger input there are more parts, not larger ones.
    One pass before measures the text.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    lengths = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in rows.dtypes if kind == "string"]
    size = rows.agg(F.sum(sum(lengths, F.lit(0)).cast("bigint")).alias("size")).first().size or 0
    return rows.repartition(tasks * max(1, ceil(size / (PART_BYTES * tasks))))


def fitted(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The pipeline fitted on dealt and stored rows, of which a task reads a bounded part."""
    with read_in_parts(rows.sparkSession, PART_BYTES):
        return pipeline.fit(rows)


def fitted_topics(topics: Pipeline, rows: DataFrame) -> PipelineModel:
    """``named_topics`` fitted on dealt rows ``clean_text``.

    Texts are split once; vocabulary and topics read the stored words.  The words are
    counted by SQL, which is the vocabulary of the counter's own fit with ties by name.
    """
    splitting, (counter, topic) = word_stages(topics), topics.getStages()[-2:]
    words = stored(splitting.transform(rows).select("filtered_words"), "topic-words")
    least = counter.getMinDF() if counter.getMinDF() >= 1 else counter.getMinDF() * words.count()
    known = vocabulary(words, "filtered_words", counter.getVocabSize(), least)
    counting = CountVectorizerModel.from_vocabulary(known, inputCol=counter.getInputCol(), outputCol=counter.getOutputCol())
    model = fitted(Pipeline(stages=[counting, topic]), words)
    discard(words)
    return PipelineModel([*splitting.stages, *model.stages])


def train(headlines: DataFrame, *keep: str, label: str = "categoria", text: str = "titular", **options) -> tuple[PipelineModel, DataFrame]:
    """A classifier fitted on all rows, and its scores of those rows.

    Splitting and hashing a text costs far more than any pass of the fit, so the
    texts' words and hashed counts are stored once, in equal parts; the fit, whose
    stages each read the rows, and the scores start from there.
    """
    classifier = text_classifier(**options)
    hashing = PipelineModel(classifier.getStages()[:3])
    rows = stored(hashing.transform(dealt(classifier_rows(headlines, *keep, label=label, text=text))), "classifier-rows")
    rest = fitted(Pipeline(stages=classifier.getStages()[3:]), rows)
    return PipelineModel([*hashing.stages, *rest.stages]), reading(score(rest, rows), rows)


def is_held_out(key: Column, percent: int = HELD_OUT_PERCENT) -> Column:
    """The row is kept from fitting, by the hash of its key alone: the same rows in every run, on every cluster.

    A row without a key is fitted on.
    """
    place = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 7), 16, 10).cast("bigint") % 100
    return F.coalesce(place < percent, F.lit(False))


def fit_tuned(rows: DataFrame, regularisations: Sequence[float] = REGULARISATIONS, seed: int = 42, parallelism: int = 2, **options) -> PipelineModel:
    """A classifier whose regularisation is chosen on a part of the rows (``label, clean_text``) that each candidate has not seen.

    Texts are hashed once, features fitted and made once; both are stored, and the
    candidates read the features; the best one by F1 is fitted again on all the rows.
    A label that only other rows have is one more class, which is never predicted.
    """
    hashing = hashing_stages(**options)
    hashed = stored(hashing.transform(rows).select("label", "rawFeatures"), "hashed-texts")
    model = _tuned(hashed, regularisations, seed, parallelism)
    discard(hashed)
    return PipelineModel([*hashing.stages, *model.stages])


def _tuned(hashed: DataFrame, regularisations: Sequence[float], seed: int, parallelism: int) -> PipelineModel:
    """The fitted stages behind the hashed counts, for rows (``label, rawFeatures``) of a stored table."""
    regression = logistic_regression()
    tuning = TrainValidationSplit(
        estimator=regression,
        estimatorParamMaps=ParamGridBuilder().addGrid(regression.regParam, list(regularisations)).build(),
        evaluator=MulticlassClassificationEvaluator(labelCol="labelIndex", metricName="f1"),
        trainRatio=0.8,
        seed=seed,
        parallelism=parallelism,
    )
    weighting = IDF(inputCol="rawFeatures", outputCol="features")
    indexing = StringIndexer(inputCol="label", outputCol="labelIndex", handleInvalid="keep")
    with read_in_parts(hashed.sparkSession, PART_BYTES):
        prepare = Pipeline(stages=[weighting, indexing]).fit(hashed)
        features = stored(prepare.transform(hashed).select("features", "labelIndex"), "classifier-features")
        best = tuning.fit(features).bestModel
    discard(features)
    return PipelineModel([*prepare.stages, best])


def held_out_predictions(
    headlines: DataFrame,
    key: str,
    label: str = "categoria",
    text: str = "titular",
    percent: int = HELD_OUT_PERCENT,
    regularisations: Sequence[float] = REGULARISATIONS,
    seed: int = 42,
    parallelism: int = 2,
    **options,
) -> tuple[PipelineModel, DataFrame]:
    """A tuned classifier fitted on the rows that are not held out, and its scores of those that are.

    Texts are hashed once for both sides; the words are made again only for who reads them.
    """
    hashing = hashing_stages(**options)
    split = dealt(classifier_rows(headlines, key, label=label, text=text).withColumn("held_out", is_held_out(F.col(key), percent)))
    rows = stored(hashing.transform(split).drop("words", "filtered_words"), "split-rows")
    rest = _tuned(rows.where("NOT held_out"), regularisations, seed, parallelism)
    words = PipelineModel(hashing.stages[:2]).transform(rows.where("held_out"))
    return PipelineModel([*hashing.stages, *rest.stages]), reading(score(rest, words), rows)


def evaluate(headlines: DataFrame, key: str, **options) -> DataFrame:
    """Accuracy, precision, recall and F1 on the rows that are held out."""
    _, predictions = held_out_predictions(headlines, key, **options)
    return reading(quality_metrics(confusion(predictions)), *predictions.working_tables)


def classify_headlines(headlines: DataFrame, output_base: str, model_path: str | None = None, **options) -> DataFrame:
    """Fit, score and store; returns the stored predictions."""
    model, predictions = train(headlines, **options)
    if model_path:
        model.write().overwrite().save(model_path)
    saved = save_predictions(predictions, output_base)
    discard(*predictions.working_tables)
    return saved


def label_distribution(rows: DataFrame, k: int = 20) -> DataFrame:
    """The most frequent labels."""
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "label").limit(k)
