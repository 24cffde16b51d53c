"""Exact token counts at every prefix, for vocabularies whose pieces are made by merges.

A merge encoding has a property that makes prefixes cheap: a sequence of pieces
is the encoding of its text exactly if every piece encodes to itself and every
two neighbours encode to themselves, because a merge across a boundary would
have to happen in the pair as well.  So a prefix ends in the one piece that
stands alone at its beginning or is compatible with the last piece of the
prefix before it, and ``count[end] = count[start] + 1``.  One pass over the
matches of the trie fills the counts of all prefixes of all chunks; which pairs
are compatible is worked out once per pair by running the merges on it, and
kept for a bounded number of pairs.

Counts are per code point and equal what the vocabulary's library gives for
``text[:n]``.  Truncation and budget questions are look-ups in them; no text is
encoded again.  NULL is the empty text and has no tokens.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rotativa.llm.common import column_types, text_slices
from rotativa.llm.pieces import ChunkStore, Vocabulary, cut, lattice, ranges, shared_vocabulary

PAIRS_KEPT = 1_000_000


class PairTable:
    """Which two pieces may stand side by side in a merge encoding.

    The left side may also be ``alone``: the beginning of a chunk, or a character
    without a piece, with which nothing merges.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.pieces = vocabulary.pieces
        self.alone = len(vocabulary.pieces)
        self.rank = {p: -s for p, s, n in zip(vocabulary.pieces, vocabulary.scores.tolist(), vocabulary.normal) if n}
        self.keys, self.valid = np.zeros(0, np.int64), np.zeros(0, bool)

    def merged(self, text: str) -> list[str]:
        """Merge the neighbours that form the best piece, the leftmost of equals, until none do."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            costs = [rank.get(a + b, np.inf) for a, b in pairwise(parts)]
            best = min(costs)
            if best == np.inf:
                break
            at = costs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * (self.alone + 1) + right
        distinct, place = np.unique(wanted, return_inverse=True)
        new = distinct[~np.isin(distinct, self.keys, assume_unique=True)]
        if len(new):
            if len(self.keys) + len(new) > PAIRS_KEPT:
                self.keys, self.valid, new = self.keys[:0], self.valid[:0], distinct
            found = []
            for key in new.tolist():
                first, second = divmod(key, self.alone + 1)
                pair = [] if first == self.alone else [self.pieces[first]]
                pair.append(self.pieces[second])
                found.append(self.merged("".join(pair)) == pair)
            keys = np.append(self.keys, new)
            order = np.argsort(keys)
            self.keys, self.valid = keys[order], np.append(self.valid, found).astype(bool)[order]
        return self.valid[np.searchsorted(self.keys, distinct)][place]


class PrefixCounter:
    """Token counts of all prefixes of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.pairs = PairTable(vocabulary)
        self.store = ChunkStore(self._counts)

    def _counts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        net = lattice(self.vocabulary, words)
        unknown = net.piece < 0
        last = np.full(len(net.data), -1, np.int64)
        last[net.first] = self.pairs.alone
        count = np.zeros(len(last), np.int32)
        for low, high in zip(net.steps[:-1].tolist(), net.steps[1:].tolist()):
            # the prefixes that end here are known: every shorter start has been seen
            fits = unknown[low:high].copy()
            known = np.flatnonzero(~fits)
            fits[known] = self.pairs.compatible(last[net.start[low + known]], net.piece[low + known])
            fits = low + np.flatnonzero(fits)
            start, end = net.start[fits], net.end[fits]
            last[end] = np.where(unknown[fits], self.pairs.alone, net.piece[fits])
            count[end] = count[start] + np.where(unknown[fits], end - start, 1)
        # the counts stand where a character ends: where the next begins, or the chunk's end
        ends = (net.data & 0xC0) != 0x80
        ends[net.first] = net.last == net.first
        nodes = np.flatnonzero(ends)
        chunk = np.searchsorted(net.last, nodes)
        filled = net.last[chunk] > net.first[chunk]
        return count[nodes[filled]], np.bincount(chunk[filled], minlength=len(words))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the prefixes of 1, 2, ... code points of texts (binary), text after text, and their lengths."""
        words, parts = cut(texts)
        codes = self.store.look_up(words)
        sizes = self.store.sizes[codes]
        inside = self.store.values[ranges(self.store.starts[codes], sizes)]
        ends = np.cumsum(sizes)
        whole = np.zeros(len(codes), np.int64)
        whole[sizes > 0] = inside[ends[sizes > 0] - 1]
        before = np.cumsum(whole) - whole  # tokens of the chunks before, over all texts
        text_ends = np.cumsum(parts)
        tokens = np.concatenate(([0], np.cumsum(whole)))[text_ends]
        lengths = np.diff(np.concatenate(([0], ends))[text_ends], prepend=0)
        shift = before - np.repeat(np.concatenate(([0], tokens[:-1])), parts)
        values = inside + np.repeat(shift, sizes)
        full = lengths > 0
        # the marker in front of a text is no code point of it
        return np.delete(values, (np.cumsum(lengths) - lengths)[full]), lengths - full


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def longest_within(values: np.ndarray, lengths: np.ndarray, budget: int) -> np.ndarray:
    """Code points of each text's longest prefix of at most ``budget`` tokens (counts may fall again)."""
    ends = np.cumsum(lengths)
    fitting = np.flatnonzero(values <= budget)
    at = np.searchsorted(fitting, ends) - 1
    found = np.where(at >= 0, fitting[at] if len(fitting) else -1, -1)
    return np.maximum(found + 1 - (ends - lengths), 0)


def token_counts(docs: DataFrame, keep: tuple[str, ...], limit: int = 4096, path: str | None = None, prefixes: bool = False) -> DataFrame:
    """Kept columns with n_bytes, n_tokens, over_limit and chars_within.

    ``chars_within`` is the length of the longest prefix that has no more than
    ``limit`` tokens; ``prefixes`` adds the count at every prefix as an array.
    """
    shared = shared_vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches):
        counter = PrefixCounter(shared.value)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                values, lengths = counter.counts(texts)
                ends = np.cumsum(lengths)
                tokens = np.where(lengths > 0, np.append(values, 0)[ends - 1], 0)
                arrays = [
                    *(part.column(name) for name in keep),
                    pc.cast(pc.binary_length(texts), pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(tokens > limit),
                    pa.array(longest_within(values, lengths, limit), pa.int64()),
                ]
                names = [*keep, "n_bytes", "n_tokens", "over_limit", "chars_within"]
                if prefixes:
                    offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())))
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = column_types(docs, *keep) + ["n_bytes BIGINT", "n_tokens BIGINT", "over_limit BOOLEAN", "chars_within BIGINT"]
    if prefixes:
        schema.append("prefix_tokens ARRAY<INT>")
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(schema))
