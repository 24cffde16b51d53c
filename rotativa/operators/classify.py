"""Text classification: pipeline, scoring, quality metrics, topics.

The pipeline is tokens, stop words, hashed term frequencies, inverse
document frequencies, label index, logistic regression.
Only the frequencies (``num_features`` numbers), the labels and the model
coefficients reach the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans, LDA
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rotativa.fixed import MAX_ITERATIONS, NUM_FEATURES
from rotativa.session import reading, stored


def _text_stages(num_features: int, stop_word_language: str) -> list:
    words = StopWordsRemover.loadDefaultStopWords(stop_word_language)
    return [
        Tokenizer(inputCol="clean_text", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=words),
        HashingTF(inputCol="filtered_words", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
    ]


def text_features(num_features: int = NUM_FEATURES, stop_word_language: str = "english") -> Pipeline:
    return Pipeline(stages=_text_stages(num_features, stop_word_language))


def logistic_regression(max_iterations: int = MAX_ITERATIONS, aggregation_depth: int = 2) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="labelIndex", maxIter=max_iterations, aggregationDepth=aggregation_depth
    )


def hashing_stages(num_features: int = NUM_FEATURES, stop_word_language: str = "english") -> PipelineModel:
    """The stages that are not fitted: words, words without stop words, hashed counts."""
    return PipelineModel(_text_stages(num_features, stop_word_language)[:-1])


def hashed_tfidf(rows: DataFrame, *keep: str, num_features: int = NUM_FEATURES, stop_word_language: str = "english") -> DataFrame:
    """Kept columns and ``features``; texts are split and hashed once, stored, and weighted from there."""
    *hashing, weighting = _text_stages(num_features, stop_word_language)
    hashed = stored(PipelineModel(hashing).transform(rows).select(*keep, "rawFeatures"), "hashed-texts")
    return reading(weighting.fit(hashed).transform(hashed).drop("rawFeatures"), hashed)


def text_classifier(
    num_features: int = NUM_FEATURES,
    max_iterations: int = MAX_ITERATIONS,
    stop_word_language: str = "english",
    aggregation_depth: int = 2,
) -> Pipeline:
    """The unfitted pipeline; a larger ``aggregation_depth`` suits very many partitions."""
    return Pipeline(
        stages=[
            *_text_stages(num_features, stop_word_language),
            StringIndexer(inputCol="label", outputCol="labelIndex"),
            logistic_regression(max_iterations, aggregation_depth),
        ]
    )


def topic_model(
    topics: int = 8, seed: int = 42, num_features: int = NUM_FEATURES, stop_word_language: str = "english"
) -> Pipeline:
    return Pipeline(
        stages=[*_text_stages(num_features, stop_word_language), KMeans(featuresCol="features", predictionCol="topic", k=topics, seed=seed)]
    )


def named_topics(
    topics: int = 8, seed: int = 42, vocabulary: int = NUM_FEATURES, min_texts: int = 2, max_iterations: int = MAX_ITERATIONS, stop_word_language: str = "english"
) -> Pipeline:
    """Topics over counted words, so that each topic has terms; the vocabulary holds the most frequent words.

    Only the vocabulary and a weight per topic and word reach the driver, whatever the number of texts.
    """
    words = StopWordsRemover.loadDefaultStopWords(stop_word_language)
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="clean_text", outputCol="words", pattern=r"\s+"),
            StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=words),
            CountVectorizer(inputCol="filtered_words", outputCol="counts", vocabSize=vocabulary, minDF=min_texts),
            LDA(featuresCol="counts", topicDistributionCol="mixture", k=topics, seed=seed, maxIter=max_iterations, optimizer="online"),
        ]
    )


def word_stages(topics: Pipeline) -> PipelineModel:
    """The stages of ``named_topics`` that are not fitted: words, words without stop words."""
    return PipelineModel(topics.getStages()[:2])


def topic_terms(model: PipelineModel, terms: int = 10) -> DataFrame:
    """``topic, rank, term, weight``: the heaviest words of each topic of ``named_topics``."""
    vocabulary = next(stage.vocabulary for stage in model.stages if isinstance(stage, CountVectorizerModel))
    described = model.stages[-1].describeTopics(terms)
    # a row per word of the vocabulary, whose size is a parameter
    names = described.sparkSession.createDataFrame(list(enumerate(vocabulary)), "number INT, term STRING")
    ranked = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "entry"))
    return ranked.join(F.broadcast(names), F.col("entry.termIndices") == F.col("number")).select(
        "topic", (F.col("rank") + 1).alias("rank"), "term", F.col("entry.termWeights").alias("weight")
    )


def main_topic(scored: DataFrame) -> DataFrame:
    """Scored texts with the topic that has the largest share; a text without known words has none."""
    shares = vector_to_array("mixture")
    largest = (F.array_position(shares, F.array_max(shares)) - 1).cast("int")
    return scored.withColumn("topic", F.when(F.array_max(shares) > 0, largest))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def for_scoring(model: PipelineModel) -> PipelineModel:
    """The fitted stages without the label index, for rows that have no label."""
    return PipelineModel([stage for stage in model.stages if not isinstance(stage, StringIndexerModel)])


def with_probability_text(predictions: DataFrame) -> DataFrame:
    """The probability vector as text, for files that cannot hold a vector."""
    return predictions.withColumn("probability_str", F.col("probability").cast("string"))


def with_top_probability(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("top_probability", F.array_max(vector_to_array("probability")))


def prediction_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("prediction").agg(F.count("*").alias("n")).orderBy("prediction")


def confusion(predictions: DataFrame) -> DataFrame:
    """Rows per true and predicted label index."""
    return predictions.groupBy("labelIndex", "prediction").agg(F.count("*").alias("n"))


def quality_metrics(confusion_counts: DataFrame) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from confusion counts."""
    hit = F.when(F.col("labelIndex") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = confusion_counts.groupBy(F.col("labelIndex").alias("class")).agg(
        F.sum("n").alias("actual"), F.sum(hit).alias("hits")
    )
    predicted = confusion_counts.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    recall = F.col("hits") / F.col("actual")
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    per_class = actual.join(predicted, "class", "left").select(
        "actual",
        "hits",
        recall.alias("r"),
        precision.alias("p"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f"),
    )
    total = F.sum("actual")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("actual")) / total

    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
        weighted("f").alias("f1"),
    )
