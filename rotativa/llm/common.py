"""What the corpus operators share: words, folds, row identity, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotativa.session import stored

WORD = r"[^\x20\x09-\x0D]+"

# A counted table of at most so many rows may be sent to every task.
BROADCAST_ROWS = 20_000

# Texts are taken from an Arrow batch in slices of about so many bytes.
SLICE_BYTES = 2_000_000


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo the number of folds; a NULL id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def identified(rows: DataFrame, purpose: str, name: str = "_row", codec: str | None = None) -> DataFrame:
    """The rows stored in the shared folder, each with a number of its own.

    The number is fixed by the writing, so rows that are equal in every column,
    or have no id, stay apart however often the table is read.
    """
    return stored(rows.withColumn(name, F.monotonically_increasing_id()), purpose, codec)


def boxed(docs: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """As ``identified``, with the document in one column ``doc``, so that no name of its columns can clash."""
    return identified(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")), purpose, codec=codec)


def sized(rows: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """The rows as a stored table, and how many they are."""
    table = stored(rows, purpose)
    return table, table.count()


def small(rows: DataFrame, count: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """A side of a join, sent to all tasks only if its counted size allows it."""
    return F.broadcast(rows) if count <= most else rows


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of bounded text size, a longer text alone, with their texts as bytes; NULL is the empty text."""
    texts = pc.fill_null(pc.cast(batch.column(column), pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, end - start), texts.slice(start, end - start)
        start = end


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts one after the other, and where each begins, with the end at last."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def column_types(rows: DataFrame, *names: str) -> list[str]:
    """Schema entries of columns that a function over batches passes on."""
    return [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in names]
