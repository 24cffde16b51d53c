"""Runs of repeated words, found by catching squares online over dyadic blocks.

A text's words are cut into blocks of 1, 2, 4, ... words.  When a block of 2^k
words is complete it becomes a catcher: it waits for words whose suffix of 2^k
words equals it, 2^(k+1) - 1 to 2^(k+2) - 2 words later.  The first half of any
square (a stretch repeated at once) of such a period holds a whole block of that
size, so every square is caught, and an appended word has two catchers of each
size to look at.  A suffix's name at one size comes from two names at the size
before, so appending a word advances all its suffix comparisons; names are
64-bit hashes, and a catch is then compared word by word.

Squares caught by neighbouring blocks at one distance are one stretch.  It is
carried on to both sides, by less than a block, and is a run if it is long
enough.  Stretches inside a run that its period already explains are not carried
on; of equal stretches the smallest period stays, which is the run's own.

Words of all texts of a slice are appended together as one vector: a word only
meets blocks that were complete before it, so what is caught is what appending
word by word catches, and work is proportional to the words times the logarithm
of a text's length.

NULL and empty texts have no words and no runs.  Texts of any length are taken
whole.  Equal texts give equal runs; every row is a document of its own, and
columns of the documents that are not kept do not matter.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotativa.llm.common import WORD, column_types, text_slices
from rotativa.llm.pieces import ranges

EXPONENT = 4  # repeats that make a run
LENGTH = 6  # words that make a run
COMPARED = 4_000_000  # words compared at once while catches are verified

# fixed values: odd multipliers of a 64-bit mixing function
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX[1]
    return values ^ (values >> np.uint64(27))


class Catchers:
    """The catchers of the texts of one slice, size by size."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, exponent: int, length: int) -> None:
        self.words, self.counts = words, counts
        self.exponent, self.length = exponent, length
        self.ends = np.cumsum(counts)
        self.text = np.repeat(np.arange(len(counts)), counts)
        # of each word: end and period of the longest run that is known to hold it
        self.run_end, self.run_period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)

    def _catches(self, name: np.ndarray, at: np.ndarray, position: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word of a block, distance of its repeat) of every block met by a suffix of its size."""
        nearest = (at - 2 * size + 2) // size * size - 1
        blocks, distances = [], []
        for end in (nearest, nearest - size):
            word = np.flatnonzero(end >= size - 1)
            distance = at[word] - end[word]
            met = np.flatnonzero(name[word] == name[word - distance])
            blocks.append(position[word[met]] - distance[met] - size + 1)
            distances.append(distance[met])
        block, distance = np.concatenate(blocks), np.concatenate(distances)
        known = (self.run_end[block] >= block + distance + size) & (distance % self.run_period[block] == 0)
        return self._verified(block[~known], distance[~known], size)

    def _verified(self, block: np.ndarray, distance: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size == 1:
            same = self.words[block] == self.words[block + distance]
        else:
            same = np.ones(len(block), bool)
            step = max(1, COMPARED // size)
            for low in range(0, len(block), step):
                inside = block[low : low + step, None] + np.arange(size)
                other = inside + distance[low : low + step, None]
                same[low : low + step] = (self.words[inside] == self.words[other]).all(axis=1)
        return block[same], distance[same]

    def _stretched(self, first: np.ndarray, last: np.ndarray, distance: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches (first to last word, last not included) that equal the words at a distance, as long as can be."""
        low, high = first.copy(), last.copy()
        least, most = (self.ends - self.counts)[text], self.ends[text]
        open_ = np.flatnonzero(low > least)
        while len(open_):
            before = low[open_] - 1
            open_ = open_[self.words[before] == self.words[before + distance[open_]]]
            low[open_] -= 1
            open_ = open_[low[open_] > least[open_]]
        open_ = np.flatnonzero(high + distance < most)
        while len(open_):
            after = high[open_]
            open_ = open_[self.words[after] == self.words[after + distance[open_]]]
            high[open_] += 1
            open_ = open_[high[open_] + distance[open_] < most[open_]]
        return low, high + distance

    def _merged(self, block: np.ndarray, distance: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squares of neighbouring blocks as one stretch each: (first, end, period), those long enough."""
        order = np.lexsort((block, distance))
        block, distance = block[order], distance[order]
        text = self.text[block]
        new = np.ones(len(block), bool)
        new[1:] = (np.diff(distance) != 0) | (np.diff(block) != size) | (np.diff(text) != 0)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(block))[: len(head)] - 1
        first, end = self._stretched(block[head], block[tail] + size, distance[head], text[head])
        period = distance[head]
        long_ = end - first >= np.maximum(self.exponent * period, self.length)
        return first[long_], end[long_], period[long_]

    def _remember(self, first: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        order = np.lexsort((-period, end - first))  # of two that hold a word the longest comes last, of equals the smallest period
        first, end, period = first[order], end[order], period[order]
        sizes = end - first
        place, ends, periods = ranges(first, sizes), np.repeat(end, sizes), np.repeat(period, sizes)
        further = self.run_end[place] < ends
        self.run_end[place[further]], self.run_period[place[further]] = ends[further], periods[further]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word in the slice, end, period) of every run, by first word, then period."""
        position = np.arange(len(self.words))
        at = position - np.repeat(self.ends - self.counts, self.counts)
        name = _mixed((self.words.astype(np.uint64) + np.uint64(1)) * MIX[0])
        total = np.repeat(self.counts, self.counts)
        found = [np.zeros((3, 0), np.int64)]
        size = 1
        while True:
            live = total >= max(self.exponent * (2 * size - 1), self.length)
            if not live.all():
                position, at, name, total = position[live], at[live], name[live], total[live]
            if not len(position):
                break
            caught = self._merged(*self._catches(name, at, position, size), size)
            if len(caught[0]):
                self._remember(*caught)
                found.append(np.stack(caught))
            longer = name.copy()
            # where a text has no two blocks yet the name is of no use, and no catcher is in reach
            longer[size:] = _mixed(name[size:] * MIX[0] + name[:-size] * MIX[2])
            name = longer
            size *= 2
        first, end, period = np.concatenate(found, axis=1)
        order = np.lexsort((period, end, first))
        first, end, period = first[order], end[order], period[order]
        own = np.ones(len(first), bool)
        own[1:] = (np.diff(first) != 0) | (np.diff(end) != 0)
        first, end, period = first[own], end[own], period[own]
        order = np.lexsort((period, first))
        return first[order], end[order], period[order]


def _slice_runs(batches, keep: tuple[str, ...], exponent: int, length: int):
    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            words = [text.split() for text in texts.to_pylist()]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            flat = [word for own in words for word in own]
            numbers = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy()
            first, end, period = Catchers(numbers, counts, exponent, length).runs()
            text = np.searchsorted(np.cumsum(counts), first, side="right")
            begins = np.cumsum(counts) - counts
            edges = np.zeros(len(flat) + 1, np.int64)
            np.add.at(edges, first + period, 1)
            np.add.at(edges, end, -1)
            stays = np.cumsum(edges[:-1]) == 0
            repeated = np.unique(text)
            for i in repeated.tolist():
                own = stays[begins[i] : begins[i] + counts[i]].tolist()
                words[i] = [word for word, stay in zip(words[i], own) if stay]
            offsets = np.searchsorted(text, np.arange(len(counts) + 1))
            runs = pa.StructArray.from_arrays(
                [pa.array(x, pa.int64()) for x in (first - begins[text], end - first, period)], names=["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(name) for name in keep),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                    pa.array([b" ".join(own).decode() for own in words], pa.string()),
                ],
                names=[*keep, "n_words", "runs", "collapsed"],
            )


def word_runs(docs: DataFrame, keep: tuple[str, ...], exponent: int = EXPONENT, length: int = LENGTH) -> DataFrame:
    """Kept columns with n_words, the runs (start, length, period), and the text with one period of each run left.

    A run repeats its period at least ``exponent`` times (2 or more), has at least
    ``length`` words, and no neighbouring word extends it.  Runs are ordered by
    start, then period.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    schema = column_types(docs, *keep) + [
        "n_words BIGINT", "runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>", "collapsed STRING"
    ]
    run = partial(_slice_runs, keep=keep, exponent=exponent, length=length)
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(schema))


def planted(text: Column, doc_id: Column) -> Column:
    """The texts of a tenth of the documents, chosen by the checksum of their id, with a repeated part at the end.

    A document without an id keeps its text.
    """
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    given = F.struct(words.alias("w"), F.crc32(doc_id.cast("string").cast("binary")).alias("h"))
    n = lambda x: F.size(x["w"])
    g = lambda x: F.floor(x["h"] / 10)
    a = lambda x: F.pmod(g(x), n(x)).cast("int")
    p = lambda x: (1 + F.floor((n(x) - a(x)) / (3 + F.pmod(g(x), F.lit(8))))).cast("int")
    placed = F.transform(F.array(given), lambda x: F.struct(x["w"].alias("w"), n(x).alias("n"), a(x).alias("a"), p(x).alias("p")))
    made = F.transform(
        placed,
        lambda x: F.array_join(
            F.concat(F.slice(x["w"], 1, x["a"]), F.transform(F.sequence(F.lit(0), x["n"] - 1 - x["a"]), lambda i: F.get(x["w"], x["a"] + F.pmod(i, x["p"])))),
            " ",
        ),
    )
    chosen = (F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0) & F.regexp_like(text, F.lit(WORD))
    return F.when(chosen, made[0]).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    # the longest run, then the one that starts first, then the shorter period
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(ranked)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(F.transform("runs", line), "").alias("lines"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
