"""Toxicity: a convolutional classifier over hashed words, trained in numpy.

A word (lower case, without punctuation at its ends) is hashed to a bucket, and
so are its first letters; the sum of their embeddings stands for it, so that
words of a family help each other.  Filters of one, two and three words slide over the whole text,
are rectified and pooled by their maximum, and a logistic layer gives the score.
Buckets that few labelled documents use share one embedding, so that a rare word
is not learnt by heart.  For scoring, the product of each distinct word of a
slice with every filter row is a table, and an answer a sum of looked-up rows.

The model is fitted on all labelled documents outside the held-out fold, a tenth of
which chooses the epoch and calibrates a threshold for each language.  They are dealt
by the hashes of their ids to shards of about ``SHARD_ROWS`` documents; in an epoch
every shard trains the net by itself, all of its documents once, and the following
epoch starts from the mean of what they made, in which a shard counts for a word's
embedding by its documents with that word.  So a task holds one shard, and the driver
the net and a number for each document that is watched.  One shard is plain training.
The language is used for that threshold only, never for the score.

NULL and empty texts pool to zero and are scored like others.  Without labelled
documents the score is 0.5; with labels of one kind it is their smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotativa.llm.common import column_types, fold, text_slices
from rotativa.llm.labels import labelled_documents
from rotativa.llm.quality import shared_model
from rotativa.session import discard, stored

FOLDS, HELD_OUT = 5, 0
SHARD_ROWS, SHARD_WORDS = 6_000, 4_000_000  # of a shard, about
BUCKETS = 1 << 18
EMBEDDING = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
LEAST_DOCUMENTS = 6
BEGINNING = 4  # letters
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_"
PAD, RARE = 0, 1
WATCHED = 10  # one of so many documents is kept for choosing and calibrating
DECAY = 1e-4  # of embeddings and filters
CACHED = 32_768  # numbers of the parameters that are stepped at once
UNITS = 1024  # rows of parameters that a task averages


def word_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets [word and beginning] of the distinct words of texts (binary), each word's number, words of each text."""
    import xxhash

    parts = pc.ascii_split_whitespace(pc.cast(texts, pa.large_string()))
    words, counts = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = pc.dictionary_encode(words)
    digest = xxhash.xxh32_intdigest
    distinct = [word.strip(EDGES) for word in pc.utf8_lower(encoded.dictionary).to_pylist()]
    buckets = np.array(
        [(digest(w) % BUCKETS, BUCKETS + digest(w[:BEGINNING]) % BUCKETS) for w in distinct], np.int64
    ).reshape(-1, 2)
    number = encoded.indices.to_numpy().astype(np.int64)
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(counts)), counts)[filled]
    return buckets, number[filled], np.bincount(text, minlength=len(counts))


@dataclass
class TextNet:
    """The trained net. ``row_of`` maps a bucket to its embedding; ``filters`` are [word, embedding, filter] by width."""

    row_of: np.ndarray
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    weight: np.ndarray
    intercept: float
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def pooled(self, buckets: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Largest rectified answers of every filter over each text, given as numbers of distinct words."""
        widest = max(WIDTHS)
        made = np.zeros((len(counts), len(WIDTHS) * FILTERS))
        filled = np.flatnonzero(counts)
        if not len(filled):
            return made
        vectors = self.embedding[self.row_of[buckets]].sum(1)
        vectors = np.concatenate((vectors, np.zeros((1, EMBEDDING))))  # the last one pads
        at = np.arange(len(words)) + np.repeat(np.arange(len(counts)) * (widest - 1), counts)
        padded = np.full(len(words) + len(counts) * (widest - 1), len(buckets))
        padded[at] = words
        begins = (np.cumsum(counts) - counts)[filled]
        for i, filters in enumerate(self.filters):
            answer = 0
            for step, part in enumerate(filters):
                answer = answer + (vectors @ part).astype(np.float32)[padded[at + step]]
            made[filled, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(answer, begins) + self.bias[i]
        return np.maximum(made, 0)

    def score(self, buckets: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.pooled(buckets, words, counts) @ self.weight + self.intercept)))


class Parameters:
    """All numbers of a net in one table of rows as long as an embedding: the embeddings, then all others."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        taken = 0
        rest = table[len(table) - OTHER_UNITS :].reshape(-1)

        def part(*shape: int) -> np.ndarray:
            nonlocal taken
            size = int(np.prod(shape))
            taken += size
            return rest[taken - size : taken].reshape(shape)

        self.embedding = table[: len(table) - OTHER_UNITS]
        self.filters = [part(width, EMBEDDING, FILTERS) for width in WIDTHS]
        self.decayed = self.embedding.size + taken
        self.bias = [part(FILTERS) for _ in WIDTHS]
        self.weight, self.intercept = part(len(WIDTHS) * FILTERS), part(1)


OTHER_UNITS = -(-(sum(WIDTHS) * EMBEDDING * FILTERS + 2 * len(WIDTHS) * FILTERS + 1) // EMBEDDING)


class Adam:
    """Steps in place, by parts of the table that stay near the processor; gradients of few rows come with the rows."""

    def __init__(self, value: np.ndarray, mean: np.ndarray, square: np.ndarray, rate: float, turn: int, decayed: int) -> None:
        self.value, self.mean, self.square, self.rate, self.turn = value, mean, square, rate, turn
        self.gradient, self.decayed = np.zeros_like(value), decayed

    def step(self, rows: np.ndarray, gradients: np.ndarray) -> None:
        self.turn += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.turn) / (1 - 0.9**self.turn)
        value, mean, square, gradient = (x.reshape(-1) for x in (self.value, self.mean, self.square, self.gradient))
        np.multiply(value[: self.decayed], DECAY, out=gradient[: self.decayed])
        gradient[self.decayed :] = 0
        self.gradient[rows] += gradients
        spare = np.empty(CACHED)
        for low in range(0, len(value), CACHED):
            v, m, s, g = (x[low : low + CACHED] for x in (value, mean, square, gradient))
            part = spare[: len(v)]
            m *= 0.9
            m += np.multiply(0.1, g, out=part)
            s *= 0.999
            np.multiply(0.001, g, out=part)
            part *= g
            s += part
            np.sqrt(s, out=part)
            part += 1e-8
            v -= np.divide(np.multiply(scale, m, out=g), part, out=part)


@dataclass
class Training:
    """What a shard needs for an epoch: values, means and squares of all parameters side by side, and what has been done."""

    units: np.ndarray
    row_of: np.ndarray
    random: np.random.Generator
    epoch: int = 0
    turn: int = 0

    def net(self) -> TextNet:
        found = Parameters(self.units[:, :EMBEDDING].copy())
        return TextNet(self.row_of, found.embedding, found.filters, found.bias, found.weight, float(found.intercept[0]))


def started(common: np.ndarray, positive: float, seed: int = 5) -> Training:
    """Random parameters, with an embedding for each of the common buckets, and one for words beyond the end and one for rare ones."""
    random = np.random.default_rng(seed)
    row_of = np.full(2 * BUCKETS, RARE)
    row_of[common] = np.arange(len(common)) + 2
    units = np.zeros((len(common) + 2 + OTHER_UNITS, 3 * EMBEDDING))
    value = np.zeros((len(units), EMBEDDING))
    made = Parameters(value)
    made.embedding[:] = random.normal(0, 0.3, made.embedding.shape)
    made.embedding[PAD] = 0
    for filters in made.filters:
        filters[:] = random.normal(0, 0.4, filters.shape)
    made.weight[:] = random.normal(0, 0.3, made.weight.shape)
    made.intercept[:] = np.log(positive / (1 - positive))
    units[:, :EMBEDDING] = value
    return Training(units, row_of, random)


def train_shard(shard: dict, training: Training, batch: int = 32, rate: float = 0.01) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(rows, weights, their parameters, turns of Adam) after an epoch over a shard, for the rows of parameters that it has."""
    rows = training.row_of[shard["buckets"].reshape(-1, 2)]
    held = np.unique(np.concatenate(([PAD, RARE], training.row_of[shard["seen"]])))
    weights = np.full(len(held), float(len(shard["learn_labels"])))
    common = training.row_of[shard["seen"]] != RARE
    weights[np.searchsorted(held, training.row_of[shard["seen"][common]])] = shard["seen_docs"][common]
    units = np.concatenate((held, np.arange(len(training.units) - OTHER_UNITS, len(training.units))))
    weights = np.concatenate((weights, np.full(OTHER_UNITS, float(len(shard["learn_labels"])))))
    rows = np.searchsorted(held, rows)
    value, mean, square = (np.ascontiguousarray(training.units[units, k * EMBEDDING : (k + 1) * EMBEDDING]) for k in range(3))
    parameters = Parameters(value)
    adam = Adam(value, mean, square, rate, training.turn, parameters.decayed)
    sizes = shard["learn_sizes"]
    begins = np.cumsum(sizes) - sizes
    random = training.random if shard["shard"] == 0 else np.random.default_rng((5, shard["shard"]))
    for _ in range(training.epoch + 1):
        order = random.permutation(np.flatnonzero(sizes > 0))
    for low in range(0, len(order), batch):
        chosen = order[low : low + batch]
        words = np.concatenate([shard["learn_words"][begins[i] : begins[i] + sizes[i]] for i in chosen])
        moved, gradients = _gradient(rows[words], sizes[chosen], shard["learn_labels"][chosen], parameters)
        adam.step(moved, gradients / len(chosen))
        parameters.embedding[PAD] = 0
    return units, weights, np.concatenate((value, mean, square), 1), adam.turn


def _gradient(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, parameters: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the parameters and the gradients there of the loss summed over texts of at least a word, which are given as rows of the
    embedding [word, 2] one after the other."""
    many, beyond = len(counts), max(WIDTHS) - 1
    made = np.zeros((OTHER_UNITS, EMBEDDING))
    found = Parameters(made)
    met, moves = [], []
    starts = np.cumsum(counts) - counts + np.arange(many) * beyond
    padded = np.full((len(rows) + many * beyond, 2), PAD)
    padded[np.arange(len(rows)) + np.repeat(np.arange(many) * beyond, counts)] = rows
    vectors = parameters.embedding[padded[:, 0]] + parameters.embedding[padded[:, 1]]
    pooled, places = np.empty((many, len(WIDTHS) * FILTERS)), []
    for i, filters in enumerate(parameters.filters):
        answer = 0
        for step, part in enumerate(filters):
            answer = answer + (vectors @ part)[step : len(vectors) - beyond + step]
        place = np.stack([low + answer[low : low + count].argmax(0) for low, count in zip(starts.tolist(), counts.tolist())])
        places.append(place)
        pooled[:, i * FILTERS : (i + 1) * FILTERS] = answer[place, np.arange(FILTERS)] + parameters.bias[i]
    active = np.maximum(pooled, 0)
    slope = 1 / (1 + np.exp(-(active @ parameters.weight + parameters.intercept[0]))) - labels
    found.intercept += slope.sum()
    found.weight += slope @ active
    back = np.where(pooled > 0, slope[:, None] * parameters.weight, 0)
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        found.bias[i] += own.sum(0)
        for step in range(width):
            seen = places[i] + step
            found.filters[i][step] += np.einsum("tfe,tf->ef", vectors[seen], own)
            moved = own[:, :, None] * parameters.filters[i][step].T
            for part in (0, 1):
                met.append(padded[seen, part].ravel())
                moves.append(moved.reshape(-1, EMBEDDING))
    at, place = np.unique(np.concatenate(met), return_inverse=True)
    summed = np.zeros((len(at), EMBEDDING))
    np.add.at(summed, place, np.concatenate(moves))
    others = np.arange(len(parameters.table) - OTHER_UNITS, len(parameters.table))
    return np.concatenate((at, others)), np.concatenate((summed, made))


def calibrated(chance: np.ndarray, labels: np.ndarray, langs: list[str | None], least: int = 10) -> dict[str | None, float]:
    """Threshold of the best F1 for each language with enough texts of both kinds; others keep 0.5."""
    found = {}
    places = {}
    for i, lang in enumerate(langs):
        places.setdefault(lang, []).append(i)
    for lang, own in places.items():
        c, y = chance[own], labels[own]
        if min(y.sum(), len(y) - y.sum()) < least:
            continue
        cuts = np.unique(np.append(c, 0.5))
        hits = y.sum() - np.searchsorted(np.sort(c[y == 1]), cuts)
        f1 = 2 * hits / (len(c) - np.searchsorted(np.sort(c), cuts) + y.sum())
        best = cuts[f1 == f1.max()]
        found[lang] = float(best[np.abs(best - 0.5).argmin()])
    return found


NUMBERS = {
    "buckets": np.int32, "seen": np.int32, "seen_docs": np.int32,
    "learn_labels": np.int8, "learn_sizes": np.int32, "learn_words": np.int32,
    "watch_labels": np.int8, "watch_sizes": np.int32, "watch_words": np.int32,
}


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, lang, place, size, words): the place of a document among all, the number of its words, and their buckets."""
    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            buckets, words, counts = word_buckets(texts)
            offsets = pa.array(np.concatenate(([0], np.cumsum(2 * counts))), pa.int32())
            place = pa.array([hash_order(i) for i in part.column("doc_id").to_pylist()], pa.int64())
            lists = pa.ListArray.from_arrays(offsets, pa.array(buckets[words].ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), part.column("lang"), place, pa.array(counts), lists],
                names=["doc_id", "label", "lang", "place", "size", "words"],
            )


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.append(True, np.diff(numbers) != 0)[: len(numbers)]]


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """A shard as one row: its distinct words as buckets, the documents of each bucket, and its texts to learn from and to watch."""
    table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    sizes = table.column("size").to_numpy()
    pairs = np.concatenate([np.zeros(0, np.int32), *(x.flatten().to_numpy() for x in table.column("words").chunks)]).reshape(-1, 2)
    encoded = pc.dictionary_encode(pa.array(pairs[:, 0].astype(np.int64) * (2 * BUCKETS) + pairs[:, 1]))
    codes, words = encoded.dictionary.to_numpy(), encoded.indices.to_numpy().astype(np.int64)
    buckets = np.stack((codes // (2 * BUCKETS), codes % (2 * BUCKETS)), 1)
    text = np.repeat(np.arange(len(sizes)), sizes)
    used = _distinct(text * len(codes) + words)
    of_text = _distinct(((used // max(1, len(codes)))[:, None] * (2 * BUCKETS) + buckets[used % max(1, len(codes))]).ravel())
    docs = np.bincount(of_text % (2 * BUCKETS), minlength=1)
    seen = np.flatnonzero(docs)
    docs = docs[seen]
    watched = np.arange(len(sizes)) % WATCHED == 0
    labels = table.column("label").to_numpy()
    found = {"buckets": buckets, "seen": seen, "seen_docs": docs}
    for name, own in (("learn", ~watched), ("watch", watched)):
        found |= {f"{name}_labels": labels[own], f"{name}_sizes": sizes[own], f"{name}_words": words[own[text]]}
    row = {"shard": key[0].as_py(), "watch_langs": table.column("lang").filter(pa.array(watched)).to_pylist()}
    row |= {name: np.ascontiguousarray(found[name], kind).tobytes() for name, kind in NUMBERS.items()}
    return pa.Table.from_pylist([row], pa.schema([("shard", pa.int64()), ("watch_langs", pa.list_(pa.string())), *((n, pa.binary()) for n in NUMBERS)]))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            yield {name: np.frombuffer(x, NUMBERS[name]) if name in NUMBERS else x for name, x in row.items()}


def _documents_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard in _shards(batches):
        yield pa.RecordBatch.from_arrays([pa.array(shard["seen"]), pa.array(shard["seen_docs"])], names=["bucket", "docs"])


def _averaged(key: tuple, table: pa.Table) -> pa.Table:
    """The weighted mean of what the shards made of some rows of parameters, in the order of the shards."""
    total, made = np.zeros(UNITS), np.zeros((UNITS, 3 * EMBEDDING))
    turn = 0
    for row in table.sort_by("shard").to_pylist():
        at, weights = np.frombuffer(row["units"], np.int32), np.frombuffer(row["weights"])
        total[at] += weights
        made[at] += (np.frombuffer(row["numbers"]).reshape(-1, 3 * EMBEDDING) - made[at]) * (weights / total[at])[:, None]
        turn = max(turn, row["turn"])
    at = np.flatnonzero(total).astype(np.int32)
    row = {"part": key[0].as_py(), "turn": turn, "units": at.tobytes(), "numbers": made[at].tobytes()}
    return pa.Table.from_pylist([row], pa.schema([("part", pa.int64()), ("turn", pa.int64()), ("units", pa.binary()), ("numbers", pa.binary())]))


def _following(shards: DataFrame, training: Training) -> Training:
    """After an epoch over all shards."""
    shared = shared_model(shards.sparkSession, training)

    def trained(batches):
        for shard in _shards(batches):
            units, weights, numbers, turn = train_shard(shard, shared.value)
            own = weights > 0
            units, weights, numbers = units[own], weights[own], numbers[own]
            for part in np.unique(units // UNITS).tolist():
                low, top = np.searchsorted(units, (part * UNITS, (part + 1) * UNITS))
                at = (units[low:top] - part * UNITS).astype(np.int32)
                rows = {"part": part, "shard": shard["shard"], "turn": turn, "units": at.tobytes()}
                rows |= {"weights": weights[low:top].tobytes(), "numbers": numbers[low:top].tobytes()}
                yield pa.RecordBatch.from_pylist([rows])

    columns = [name for name in shards.columns if not name.startswith("watch")]
    made = shards.select(*columns).mapInArrow(trained, "part BIGINT, shard BIGINT, turn BIGINT, units BINARY, weights BINARY, numbers BINARY")
    means = stored(made.groupBy("part").applyInArrow(_averaged, "part BIGINT, turn BIGINT, units BINARY, numbers BINARY"), "toxic-means")
    units, turn = training.units.copy(), training.turn
    for row in means.toArrow().to_pylist():
        at = row["part"] * UNITS + np.frombuffer(row["units"], np.int32)
        units[at] = np.frombuffer(row["numbers"]).reshape(-1, 3 * EMBEDDING)
        turn = max(turn, row["turn"])
    discard(means)
    shared.destroy()
    return Training(units, training.row_of, training.random, training.epoch + 1, turn)


def _watched(shards: DataFrame, net: TextNet) -> np.ndarray:
    """Chances of the watched documents, in the order of the shards."""
    shared = shared_model(shards.sparkSession, net)

    def scored(batches):
        for shard in _shards(batches):
            chance = shared.value.score(shard["buckets"].reshape(-1, 2), shard["watch_words"], shard["watch_sizes"])
            yield pa.RecordBatch.from_pylist([{"shard": shard["shard"], "chance": chance.tobytes()}])

    rows = shards.select("shard", "buckets", "watch_words", "watch_sizes").mapInArrow(scored, "shard BIGINT, chance BINARY").toArrow()
    shared.destroy()
    return np.concatenate([np.zeros(0), *(np.frombuffer(x) for x in rows.sort_by("shard").column("chance").to_pylist())])


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SHARD_ROWS, epochs: int = 12, patience: int = 2) -> TextNet:
    """The net fitted on all labelled documents, in shards of about so many rows."""
    sample = labelled_documents(docs, labels, "toxic", FOLDS, HELD_OUT, ("lang",))
    schema = ", ".join([*column_types(sample, "doc_id", "label", "lang"), "place BIGINT, size BIGINT, words ARRAY<INT>"])
    hashed = stored(sample.mapInArrow(_hashed, schema), "toxic-words")
    n, words, toxic = hashed.agg(F.count("*"), F.sum("size"), F.sum("label")).first()
    positive = ((toxic or 0) + 1) / (n + 2)
    if toxic in (None, 0, n):
        discard(hashed)
        none = started(np.zeros(0, np.int64), positive).net()
        return TextNet(none.row_of, none.embedding, none.filters, none.bias, np.zeros_like(none.weight), none.intercept)

    parts = max(-(-n // rows), -(-words // SHARD_WORDS))
    fields = ", ".join(f"{name} BINARY" for name in NUMBERS)
    shards = stored(
        hashed.withColumn("shard", F.col("place") % parts)
        .repartitionByRange(parts, "shard")
        .groupBy("shard")
        .applyInArrow(_packed, f"shard BIGINT, watch_langs ARRAY<STRING>, {fields}"),
        "toxic-shards",
        "zstd",
    )
    discard(hashed)
    seen = shards.select("seen", "seen_docs").mapInArrow(_documents_of_buckets, "bucket INT, docs INT")
    counted = seen.groupBy("bucket").agg(F.sum("docs").alias("docs"))
    common = np.sort(counted.where(F.col("docs") >= LEAST_DOCUMENTS).select("bucket").toArrow().column("bucket").to_numpy())
    judged = sorted(shards.select("shard", "watch_labels", "watch_langs").toArrow().to_pylist(), key=lambda row: row["shard"])
    truth = np.concatenate([np.frombuffer(row["watch_labels"], np.int8) for row in judged]).astype(float)
    langs = [lang for row in judged for lang in row["watch_langs"]]

    training, best, best_loss, since = started(common, positive), None, np.inf, 0
    for _ in range(epochs):
        training = _following(shards, training)
        net = training.net()
        chance = np.clip(_watched(shards, net), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(truth == 1, np.log(chance), np.log(1 - chance)))
        since += 1
        if loss < best_loss:
            best, best_loss, since = net, loss, 0
            best.thresholds = calibrated(chance, truth, langs)
        if since > patience:
            break
    discard(shards)
    return best


def hash_order(doc_id: int) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(str(doc_id).encode())


def score_toxicity(docs: DataFrame, net: TextNet) -> DataFrame:
    """doc_id, held_out, score, predicted, and with its language's threshold: threshold, flagged."""
    shared = shared_model(docs.sparkSession, net)

    def scored(batches):
        model = shared.value
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                score = model.score(*word_buckets(texts))
                limit = [model.thresholds.get(lang, 0.5) for lang in part.column("lang").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score), pa.array(limit, pa.float64())], names=["doc_id", "score", "threshold"]
                )

    rows = docs.select("doc_id", "text", "lang")
    schema = ", ".join([*column_types(rows, "doc_id"), "score DOUBLE", "threshold DOUBLE"])
    return rows.mapInArrow(scored, schema).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )
