"""Text features: tokens, stop words, hashed and exact TF-IDF, label index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from rotativa.fixed import NUM_FEATURES
from rotativa.session import reading, stored

def with_words(rows: DataFrame, text: str = "clean_text") -> DataFrame:
    return Tokenizer(inputCol=text, outputCol="words").transform(rows)


def without_stop_words(rows: DataFrame, stop_words: Sequence[str] | None = None, language: str = "english") -> DataFrame:
    """Words that are no stop words, as ``filtered_words``."""
    words = list(stop_words) if stop_words is not None else StopWordsRemover.loadDefaultStopWords(language)
    return StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=words).transform(rows)


def word_counts(rows: DataFrame, words: str = "words") -> DataFrame:
    """How often each word occurs over all rows."""
    # explode_outer keeps the optimizer from tokenizing a second time to look for empty arrays.
    exploded = rows.select(F.explode_outer(words).alias("word")).where(F.col("word").isNotNull())
    return exploded.groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(rows: DataFrame, words: str, most: int, min_texts: float) -> list[str]:
    """The ``most`` most frequent words that are in at least ``min_texts`` texts, ties by name; only these reach the driver."""
    texts = word_counts(rows.select(F.array_distinct(words).alias(words)), words).where(F.col("n") >= min_texts)
    ranked = word_counts(rows, words).join(texts.select("word"), "word").orderBy(F.desc("n"), "word").limit(most)
    return [row.word for row in ranked.collect()]


def hashed_term_frequencies(rows: DataFrame, num_features: int = NUM_FEATURES) -> DataFrame:
    return HashingTF(inputCol="filtered_words", outputCol="rawFeatures", numFeatures=num_features).transform(rows)


def inverse_document_frequency(texts: Column, texts_with_term: Column) -> Column:
    return F.log((texts + 1) / (texts_with_term + 1))


def term_frequencies(rows: DataFrame, key: str, words: str = "words") -> DataFrame:
    """``key, term, tf`` of every text.

    A text is one row, so its words are sorted and counted in that row and
    nothing is shuffled.  Texts without words go last: a filter before would make
    the words a second time.
    """
    ordered = rows.select(key, F.sort_array(words).alias("ordered"))
    begins = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size("ordered") - 1, F.lit(0))),
        lambda i: (i == 0) | (F.get("ordered", i) != F.get("ordered", i - 1)),
    )
    runs = ordered.withColumn("begins", begins)
    ends = F.concat(F.slice("begins", 2, F.size("begins")), F.array(F.size("ordered")))
    counted = F.zip_with(
        F.col("begins"),
        ends,
        lambda begin, end: F.struct(F.get("ordered", begin).alias("term"), (end - begin).cast("bigint").alias("tf")),
    )
    return runs.select(key, F.inline_outer(F.when(F.size("ordered") > 0, counted))).where("term IS NOT NULL")


def tfidf_terms(rows: DataFrame, key: str, words: str = "words") -> DataFrame:
    """Exact TF-IDF: ``key, term, tf, df, tfidf`` of every term of every text (one row per key).

    Texts are counted once: their terms are stored, the document frequency is
    the number of stored rows of a term, and each row meets the one of its term
    in a single join.  That side has one row per term, so adaptive execution
    splits a term that holds a large part of all rows like any other skew.
    """
    texts = rows.agg(F.count("*")).scalar()
    tf = stored(term_frequencies(rows, key, words), "term-frequencies")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = inverse_document_frequency(texts, F.col("df"))
    found = tf.join(df, "term").select(key, "term", "tf", "df", F.round(F.col("tf") * idf, 6).alias("tfidf"))
    return reading(found, tf)


def label_index(rows: DataFrame, label: str = "label") -> DataFrame:
    """Labels by frequency, ties by name: the index the classifier uses.

    Labels are counted, dealt to ranges in their order and stored.  A label's
    index is its place in its range after the labels of all ranges before, so
    no task sees more than one range, however many labels there are.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    dealt = stored(
        counts.repartitionByRange(F.desc("n"), F.col(label)).withColumn("_range", F.spark_partition_id()), "label-ranges"
    )
    ranges = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranges.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.desc("n"), label)) - 1
    ranked = dealt.join(starts, "_range").select(label, "n", (F.col("_start") + place).cast("double").alias("label_index"))
    return reading(ranked, dealt)
