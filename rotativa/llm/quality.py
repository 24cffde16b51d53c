"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the bytes, words and lines of the whole text.  The trees
are grown level by level to a fixed depth on binned statistics, by the second
order gain of the logistic loss, and stand as arrays in which the children of
node i are 2 i + 1 and 2 i + 2; scoring moves all documents of a batch down one
level at a time.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents (a parameter).
Their statistics, not their texts, go to the driver, where the trees are grown.

NULL and empty texts have statistics of zero and are scored like others.  With
no labelled document the score is 0.5, with labels of one kind it is their
smoothed share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotativa.llm.common import column_types, fold, joined, text_slices
from rotativa.llm.labels import labelled_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
SAMPLE_ROWS = 20_000

# Kinds of bytes whose share of a text is a statistic.
BYTE_KINDS = (
    b" ",
    b"\n",
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".",
    b",",
    b"!?",
    b"|\t",
    b"#$%&*@^~+=<>/\\_{}[]",
    b"'\"`;:()-",
    bytes(range(128, 256)),
)
STATISTICS = len(BYTE_KINDS) + 9


def _kind_table() -> np.ndarray:
    table = np.full(256, len(BYTE_KINDS), np.int64)
    for kind, members in enumerate(BYTE_KINDS):
        table[list(members)] = kind
    return table


KIND_OF = _kind_table()


def text_statistics(text: bytes, data: np.ndarray) -> np.ndarray:
    """The statistics of one text, given as bytes and as an array of them."""
    made = np.zeros(STATISTICS)
    if not text:
        return made
    kinds = np.bincount(KIND_OF[data], minlength=len(BYTE_KINDS) + 1)
    made[: len(BYTE_KINDS)] = kinds[:-1] / len(text)
    words, lines = text.split(), text.split(b"\n")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    filled = [line for line in lines if line]
    made[len(BYTE_KINDS) :] = (
        np.log1p(len(text)),
        np.log1p(len(words)),
        sizes.mean() if len(words) else 0.0,
        sizes.std() if len(words) else 0.0,
        len(set(words)) / max(len(words), 1),
        len(text) / len(lines),
        len(set(filled)) / max(len(filled), 1),
        np.mean(sizes > 15) if len(words) else 0.0,
        max(map(len, lines)) / len(text),
    )
    return made


def statistics(texts: pa.Array) -> np.ndarray:
    data, begins = joined(texts)
    whole = data.tobytes()
    rows = [text_statistics(whole[a:b], data[a:b]) for a, b in zip(begins[:-1], begins[1:])]
    return np.array(rows).reshape(-1, STATISTICS)


@dataclass
class BoostedTrees:
    """Trees as arrays: [tree, node] for inner nodes, [tree, leaf] for leaves."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.prior)
        row = np.arange(len(values))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(values), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (values[row, feature[node]] > threshold[node])
            total += leaf[node - (len(leaf) - 1)]
        return total

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(values)))


def fit_trees(
    values: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    ridge: float = 2.0,
    least_weight: float = 2.0,
) -> BoostedTrees:
    nodes, leaves = 2**depth - 1, 2**depth
    positive = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(positive / (1 - positive)))
    if len(labels) == 0 or labels.min() == labels.max():
        return BoostedTrees(prior, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, leaves)))
    count, width = values.shape
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in values.T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, values.T)])
    cell = binned + np.arange(width) * bins
    made = ([], [], [])
    raw = np.full(count, prior)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-raw))
        gradient, weight = chance - labels, chance * (1 - chance)
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, bins, np.int64)
        node = np.zeros(count, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * bins) + cell).ravel()
            size = many * width * bins
            g = np.bincount(place, np.repeat(gradient, width), size).reshape(many, width, bins).cumsum(2)
            h = np.bincount(place, np.repeat(weight, width), size).reshape(many, width, bins).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < least_weight) | (h_all - h < least_weight)] = 0
            best = gain.reshape(many, -1).argmax(1)
            useful = gain.reshape(many, -1)[np.arange(many), best] > 1e-9
            feature[first : first + many] = np.where(useful, best // bins, 0)
            cut[first : first + many] = np.where(useful, best % bins, bins)  # no cut: all go left
            node = 2 * node + 1 + (binned[np.arange(count), feature[node]] > cut[node])
        at = node - nodes
        leaf = -rate * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + ridge)
        raw += leaf[at]
        threshold = [edges[f][c] if c < len(edges[f]) else np.inf for f, c in zip(feature, cut)]
        for part, new in zip(made, (feature, threshold, leaf)):
            part.append(new)
    return BoostedTrees(prior, *(np.array(part) for part in made))


def _per_slice(made):
    """For mapInArrow: the batches that ``made`` gives for a slice and its texts' statistics."""

    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                yield made(part, statistics(texts))

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> BoostedTrees:
    def measured(part, values):
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("label"), pa.array(list(values), pa.list_(pa.float64()))],
            names=["doc_id", "label", "values"],
        )

    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, rows)
    schema = ", ".join([*column_types(sample, "doc_id"), "label INT", "values ARRAY<DOUBLE>"])
    found = sample.mapInArrow(_per_slice(measured), schema).toArrow()
    values = np.array(found.column("values").to_pylist(), float).reshape(-1, STATISTICS)
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort((*values.T, y, found.column("doc_id").to_numpy()))  # the same fit whatever order rows arrive in
    return fit_trees(values[order], y[order])


def shared_model(spark: SparkSession, model):
    """A fitted model for all tasks: its size is set by parameters, not by the corpus."""
    return spark.sparkContext.broadcast(model)


def score_quality(docs: DataFrame, model: BoostedTrees) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = shared_model(docs.sparkSession, model)

    def scored(part, values):
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(shared.value.score(values))], names=["doc_id", "score"]
        )

    rows = docs.select("doc_id", "text")
    schema = ", ".join([*column_types(rows, "doc_id"), "score DOUBLE"])
    return rows.mapInArrow(_per_slice(scored), schema).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, model: BoostedTrees, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that reach the threshold, with all their columns."""
    shared = shared_model(docs.sparkSession, model)

    def kept(part, values):
        return part.filter(pa.array(shared.value.score(values) >= threshold))

    return docs.mapInArrow(_per_slice(kept), docs.schema)
