"""Labelled rows for fitting outside the held-out fold: a bounded sample, or all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotativa.llm.common import fold, small


SENT_IDS = 1_000_000  # labelled ids that may be sent to all tasks


def _labelled_ids(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    return (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & (fold(F.col("_id"), folds) != held_out))
        .groupBy("_id")
        .agg(F.min("label").alias("label"))
    )


def _documents(docs: DataFrame, ids: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    columns = ("doc_id", "text", *keep, "label")
    found = docs.select("doc_id", "text", *keep).join(ids, F.col("doc_id") == F.col("_id"))
    one = F.min_by(F.struct(*columns), F.struct(F.xxhash64("text"), "text", *keep))
    return found.groupBy("_id").agg(one.alias("one")).select(*(F.col(f"one.{c}").alias(c) for c in columns))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Documents (doc_id, text, kept columns, label) of at most ``rows`` labelled ids, held-out ids left out.

    The ids are those with the smallest hashes, so any run and any size of table
    draws them alike.  Labels other than 0 and 1 and NULL ids are not used; an id
    labelled both ways counts as the smaller label.  Of an id that several documents
    have, the document with the smallest text hash counts, so ``rows`` bounds documents.
    """
    ids = _labelled_ids(labels, label, folds, held_out).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return _documents(docs, small(ids, rows), keep)


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same of all labelled ids."""
    ids = _labelled_ids(labels, label, folds, held_out)
    return _documents(docs, small(ids, ids.count(), SENT_IDS), keep)
