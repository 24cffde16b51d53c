"""SentencePiece encoding and decoding: the most probable pieces of a unigram model.

Every chunk's matches come from the double-array trie; the best path maximises
the sum of log scores, equal sums going to the path whose last piece starts
earlier.  The paths of all chunks of a slice are advanced together, one start
position at a time.  A character without a piece costs the least score less ten
and is written as the pieces of its UTF-8 bytes.

Decoding turns markers into spaces, drops the one put in front and joins byte
pieces, so that ``decode(encode(text)) == text`` for every text, also where the
marker itself stands in it: that is written as bytes.

NULL and empty texts have no tokens.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rotativa.llm.common import column_types, joined, text_slices
from rotativa.llm.pieces import MARK, MARK_BYTES, RAW_MARK, ChunkStore, Vocabulary, cut, lattice, ranges, shared_vocabulary

UNKNOWN_PENALTY = 10.0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def zipf_scores(vocabulary: Vocabulary) -> np.ndarray:
    """Log scores by rank: the n-th piece of the vocabulary has probability 1 / (n H).

    A vocabulary that was made by merges states an order of its pieces and no
    probabilities; nothing is trained here.
    """
    order = np.flatnonzero(vocabulary.normal)
    order = order[np.argsort(-vocabulary.scores[order], kind="stable")]
    rank = np.arange(1, len(order) + 1)
    scores = np.full(len(vocabulary.pieces), -math.inf)
    scores[order] = -np.log(rank) - math.log(np.sum(1 / rank))
    return scores


class Unigram:
    """Encoder and decoder over a vocabulary and the log scores of its pieces."""

    def __init__(self, vocabulary: Vocabulary, scores: np.ndarray | None = None) -> None:
        self.vocabulary = vocabulary
        self.scores = zipf_scores(vocabulary) if scores is None else scores
        self.unknown = float(self.scores[vocabulary.normal].min()) - UNKNOWN_PENALTY
        self.store = ChunkStore(self._best_pieces)
        texts = [p.replace(MARK, " ").encode() if n else b"" for p, n in zip(vocabulary.pieces, vocabulary.normal)]
        for byte, number in enumerate(vocabulary.byte_ids):
            texts[number] = bytes([byte])
        self.text_size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)

    def _best_pieces(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        net = lattice(self.vocabulary, words)
        start, end, piece = net.start, net.end, net.piece
        score = np.where(piece >= 0, self.scores[piece], self.unknown)
        best = np.full(len(net.data), -np.inf)
        best[net.first] = 0.0
        back = np.full(len(best), -1)
        for low, high in zip(net.steps[:-1].tolist(), net.steps[1:].tolist()):
            reached = best[start[low:high]] + score[low:high]
            target = end[low:high]
            better = np.flatnonzero(reached > best[target])
            best[target[better]] = reached[better]
            back[target[better]] = low + better

        chosen = np.zeros(len(start), bool)
        node, origin = net.last, net.first
        while len(node):
            open_ = np.flatnonzero(node != origin)
            node, origin = back[node[open_]], origin[open_]
            chosen[node] = True
            node = start[node]
        path = np.flatnonzero(chosen)
        path = path[np.argsort(start[path], kind="stable")]
        raw = net.data[start[path]] == RAW_MARK[0]
        sizes = np.where(piece[path] >= 0, 1, np.where(raw, len(MARK_BYTES), end[path] - start[path]))
        values = np.repeat(piece[path], sizes)
        spelled = np.flatnonzero(values < 0)
        spelling = np.append(net.data, np.frombuffer(MARK_BYTES, np.uint8))
        origin = np.where(raw, len(net.data), start[path])
        values[spelled] = self.vocabulary.byte_ids[spelling[ranges(origin, sizes)[spelled]]]
        return values, np.bincount(np.repeat(net.chunk[path], sizes), minlength=len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts (binary) one after the other, and the number of each text's."""
        words, counts = cut(texts, reversible=True)
        codes = self.store.look_up(words)
        sizes = self.store.sizes[codes]
        values = self.store.values[ranges(self.store.starts[codes], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
        return values, np.diff(ends, prepend=0)

    def decode(self, values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the decoded texts one after the other, and the number of each text's."""
        lengths = self.text_size[values]
        data = self.text_bytes[ranges(self.text_start[values], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(sizes)]
        counts = np.diff(ends, prepend=0)
        full = counts > 0
        return np.delete(data, (ends - counts)[full]), counts - full  # the marker in front


def encode_texts(
    docs: DataFrame, keep: tuple[str, ...], path: str | None = None, scores: np.ndarray | None = None
) -> DataFrame:
    """Kept columns with n_bytes, n_tokens, the token ids, and whether they decode to the text."""
    shared = shared_vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches):
        model = Unigram(shared.value, scores)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                values, sizes = model.encode(texts)
                back, lengths = model.decode(values, sizes)
                data, begins = joined(texts)
                same = lengths == np.diff(begins)
                if not same.all() or not np.array_equal(back, data):
                    at = np.concatenate(([0], np.cumsum(lengths)))
                    same = [
                        np.array_equal(back[at[i] : at[i + 1]], data[begins[i] : begins[i + 1]])
                        for i in range(len(lengths))
                    ]
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in keep),
                        pa.array(np.diff(begins), pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())),
                        pa.array(same, pa.bool_()),
                    ],
                    names=[*keep, "n_bytes", "n_tokens", "tokens", "round_trip"],
                )

    made = ["n_bytes BIGINT", "n_tokens BIGINT", "tokens ARRAY<INT>", "round_trip BOOLEAN"]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(column_types(docs, *keep) + made))


def decode_tokens(rows: DataFrame, keep: tuple[str, ...], path: str | None = None) -> DataFrame:
    """Kept columns with the text of a column ``tokens``; NULL lists give NULL.

    Bytes that are not UTF-8 (which no encoded text gives) become U+FFFD.
    """
    shared = shared_vocabulary(rows.sparkSession, path or default_vocabulary())

    def run(batches):
        model = Unigram(shared.value)
        for batch in batches:
            texts = []
            for tokens in batch.column("tokens"):
                values = np.asarray(tokens.values if tokens.is_valid else [], np.int64)
                data, _ = model.decode(values, np.array([len(values)]))
                texts.append(data.tobytes().decode(errors="replace") if tokens.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(texts, pa.string())], names=[*keep, "text"]
            )

    return rows.select(*keep, "tokens").mapInArrow(run, ", ".join([*column_types(rows, *keep), "text STRING"]))
