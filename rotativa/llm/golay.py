"""SimHash near-duplicates: Golay-code fuzzy hashing of 64-bit fingerprints.

A fingerprint is cut into three segments of 21, 21 and 22 bits, each a word of
the binary Golay code of length 23.  That code is perfect with radius 3: a word
has one codeword within 3 bits, and if that is exactly 3 away, five more at 4.
Two words that differ in at most 2 bits have a word half-way between them, whose
codeword is within 4 bits of both, so their sets of such codewords meet.

If two fingerprints differ in at most 2 bits, some segment is equal in both
(three segments, two errors), and the segment after it differs in at most 2.
So the equal segment together with a shared codeword of the next one is a key
of 33 or 34 bits that both have; a fingerprint has 3 to 18 keys, 16 on average.
Fingerprints are collapsed before, joined on their keys and verified.

A bucket of more than ``BUCKET_ROWS`` fingerprints is not paired.  Its members
are joined exactly and in proportion to their number by the 65 words within one
bit of each: two fingerprints share such a word if and only if they differ in
at most 2 bits, and every member is linked to the smallest at that word.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotativa.llm.common import boxed, column_types, sized, small, text_slices
from rotativa.llm.components import components
from rotativa.session import discard, reading, stored

SEED = 42
SHINGLE_WORDS = 3
BITS_APART = 2
BUCKET_ROWS = 64
SENT_ROWS = 500_000  # rows of two longs that may be sent to all tasks
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit and size

# fixed values: generator polynomial of the Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1
GENERATOR = 0b110001110101

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes) -> int:
    """SimHash of a text's three-word shingles (repeats included) under XXH64 with seed 42."""
    import xxhash

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1)).tolist()
    wide = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(begins, ends[wide - 1 :].tolist())), np.uint64, len(words) - wide + 1
    )
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        octets = hashes[part : part + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Kept columns and the fingerprint as a signed long; NULL texts have no words and so fingerprint zero."""

    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                found = np.array([fingerprint(text) for text in texts.to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(found)], names=[*keep, "fingerprint"])

    schema = ", ".join([*column_types(docs, *keep), "fingerprint BIGINT"])
    return docs.select(*keep, "text").mapInArrow(run, schema)


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator polynomial: 0 for codewords."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@cache
def error_table() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the errors of at most 4 bits that lead to codewords (padded), and how many."""
    errors = np.array([sum(1 << bit for bit in bits) for weight in range(5) for bits in combinations(range(23), weight)])
    table, count = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for error, syndrome in zip(errors.tolist(), syndromes(errors).tolist()):
        table[syndrome, count[syndrome]] = error
        count[syndrome] += 1
    return table, count


def keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, key) for all keys of fingerprints."""
    table, count = error_table()
    value = values.view(np.uint64)
    parts = [(value >> np.uint64(first) & np.uint64((1 << size) - 1)).astype(np.int64) for first, size in SEGMENTS]
    rows, found = [], []
    for i, exact in enumerate(parts):
        near = parts[(i + 1) % len(parts)]
        syndrome = syndromes(near)
        many = count[syndrome]
        row = np.repeat(np.arange(len(values)), many)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        codeword = near[row] ^ table[syndrome[row], turn]
        rows.append(row)
        found.append((i << 34) | (exact[row] << 12) | (codeword >> 11))  # the upper 12 bits name a codeword
    return np.concatenate(rows), np.concatenate(found)


def _with_keys(batches):
    for batch in batches:
        values = batch.column("fingerprint").to_numpy()
        row, key = keys(values)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[row])], names=["key", "fingerprint"])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints reachable by steps of at most 2 bits, as a stored table."""
    keyed = stored(distinct.select("fingerprint").mapInArrow(_with_keys, "key BIGINT, fingerprint BIGINT"), "golay-keys")
    shared, count = sized(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "golay-shared")
    met = stored(keyed.join(small(shared, count, SENT_ROWS), "key"), "golay-met")
    discard(keyed, shared)
    few = met.where(F.col("members") <= BUCKET_ROWS).select("key", "fingerprint")
    pairs = (
        few.withColumnRenamed("fingerprint", "a")
        .join(few.withColumnRenamed("fingerprint", "b"), "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS_APART))
        .select("a", "b")
    )
    bits = F.sequence(F.lit(0), F.lit(63))
    crowded = met.where(F.col("members") > BUCKET_ROWS).select("fingerprint").distinct()
    ball = stored(
        crowded.select("fingerprint", F.explode(F.concat(F.array(F.lit(-1)), bits)).alias("bit")).select(
            "fingerprint",
            F.when(F.col("bit") < 0, F.col("fingerprint"))
            .otherwise(F.col("fingerprint").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))))
            .alias("word"),
        ),
        "golay-ball",
    )
    nearest = ball.groupBy("word").agg(F.min("fingerprint").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = ball.join(nearest, "word").where("a <> fingerprint").select("a", F.col("fingerprint").alias("b"))
    found = stored(pairs.unionByName(stars), "golay-links")
    discard(met, ball)
    return found


def groups(rows: DataFrame, least: str) -> DataFrame:
    """(fingerprint, smallest): for each distinct fingerprint the smallest ``least`` of its group.

    ``rows`` is read twice: give a stored table.
    """
    distinct = stored(rows.groupBy("fingerprint").agg(F.min(least).alias("_least")), "golay-distinct")
    found = links(distinct)
    linked = components(found).select(F.col("node").alias("_node"), "component")
    named = stored(
        distinct.join(linked, F.col("fingerprint") == F.col("_node"), "left").select(
            "fingerprint", "_least", F.coalesce("component", "fingerprint").alias("_group")
        ),
        "golay-groups",
    )
    best, count = sized(named.groupBy(F.col("_group").alias("_g")).agg(F.min("_least").alias("smallest")), "golay-best")
    made = stored(named.join(small(best, count), F.col("_group") == F.col("_g")).select("fingerprint", "smallest"), "golay-named")
    discard(distinct, found, named, best)
    return made


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document.

    A document without words has fingerprint zero and is linked like any other;
    equal texts share a fingerprint; NULL ids count for no minimum, and a group
    of nothing else has a NULL id.
    """
    rows = stored(fingerprints(docs, ("doc_id",)), "golay-fingerprints")
    found = groups(rows, "doc_id")
    return rows.join(small(found, found.count()), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("smallest").alias("component_id")
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """The documents without all but the first (by id, then by place) of every group, with their columns."""
    rows = boxed(docs, "golay-documents")
    prints = fingerprints(rows.select("_row", F.col("doc.doc_id").alias("id"), F.col("doc.text").alias("text")), ("_row", "id"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "_row")
    prints = stored(prints.select("fingerprint", "_row", order.alias("order")), "golay-fingerprints")
    found = groups(prints, "order")
    repeated, count = sized(
        prints.join(small(found, found.count()), "fingerprint").where(F.col("smallest._row") != F.col("_row")).select("_row"),
        "golay-repeated",
    )
    discard(prints, found)
    kept = rows.join(small(repeated, count, SENT_ROWS), "_row", "left_anti").select("doc.*")
    return reading(kept, rows, repeated)
