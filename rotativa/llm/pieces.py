"""Pieces of a public vocabulary in a double-array trie, and the lattice of their matches.

Texts are cut into chunks at places no piece can cross: before a run of space
markers, and around line breaks.  Chunks repeat, so a worker keeps what it has
worked out for a bounded number of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

MARK = "▁"
MARK_BYTES = MARK.encode()
END = 0xFF  # closes a chunk; like the next one, no byte of UTF-8
RAW_MARK = b"\xfe"  # a marker that stands in the text itself
CHUNKS_KEPT = 600_000


@dataclass(frozen=True)
class Vocabulary:
    """Piece texts by id, their scores as stored, the ids of the 256 byte pieces, and the trie."""

    pieces: list[str]
    scores: np.ndarray
    normal: np.ndarray  # bool by id: neither control nor unknown nor byte piece
    byte_ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays: the child of state s by byte b is ``base[s] + b`` if its check is s."""
    ordered = sorted(keys)
    size = 1024 + 4 * sum(map(len, ordered))
    used = bytearray(size)
    base, check, value = (np.full(size, -1, np.int32) for _ in range(3))
    used[0] = 1
    work = [(0, 0, len(ordered), 0)]
    while work:
        state, low, high, depth = work.pop()
        if low < high and len(ordered[low]) == depth:
            value[state] = keys[ordered[low]]
            low += 1
        children: list[tuple[int, int, int]] = []
        while low < high:
            byte, start = ordered[low][depth], low
            while low < high and ordered[low][depth] == byte:
                low += 1
            children.append((byte, start, low))
        if not children:
            continue
        slot = used.find(0, children[0][0] + 1)
        while any(used[slot - children[0][0] + byte] for byte, _, _ in children):
            slot = used.find(0, slot + 1)
        base[state] = offset = slot - children[0][0]
        for byte, start, end in children:
            used[offset + byte] = 1
            check[offset + byte] = state
            work.append((offset + byte, start, end, depth + 1))
    top = len(used.rstrip(b"\0")) + 256
    base = np.where(base < 0, top, base)  # a leaf leads to the free end
    check = np.append(check[:top], np.full(512, -1, np.int32))
    return base[:top].astype(np.int64), check, value[:top]


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a piece vocabulary file.

    Pieces that hold a marker after another character, or a line break, would
    cross the cuts between chunks; a vocabulary with such pieces is refused.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    byte_ids = np.full(256, -1, np.int32)
    normal = np.zeros(len(pieces), bool)
    for i in ids:
        if model.is_byte(i):
            byte_ids[int(pieces[i][1:-1], 16)] = i
        else:
            normal[i] = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    known = [pieces[i] for i in ids if normal[i]]
    if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in known) or (byte_ids < 0).any():
        raise ValueError("pieces must not cross words or lines, and all 256 byte pieces must be there")
    trie = double_array({pieces[i].encode(): i for i in ids if normal[i]})
    return Vocabulary(pieces, np.array([model.get_score(i) for i in ids]), normal, byte_ids, *trie)


def shared_vocabulary(spark: SparkSession, path: str):
    """The vocabulary for all tasks: its size is that of the file, whatever the corpus."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def cut(texts: pa.Array, reversible: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The chunks of texts (binary, no NULL) one after the other, and the number of each text's.

    Spaces become markers, and one is put in front of a text that is not empty.
    A marker in the text itself is a space, as for the vocabulary's library, or
    stays apart from spaces if the cut is to be reversible.
    """
    body = pc.replace_substring(texts, MARK_BYTES, RAW_MARK if reversible else b" ")
    body = pc.replace_substring(body, b" ", b" " + MARK_BYTES)
    mark, nothing = (pa.scalar(x, texts.type) for x in (MARK_BYTES, b""))
    body = pc.binary_join_element_wise(mark, body, nothing)
    for _ in range(2):  # a run of spaces is one chunk: pairs are joined, then the pairs
        body = pc.replace_substring(body, MARK_BYTES + b" " + MARK_BYTES, MARK_BYTES + MARK_BYTES)
    body = pc.replace_substring(body, b"\n", b" \n ")
    if reversible:
        body = pc.replace_substring(body, RAW_MARK, b" " + RAW_MARK + b" ")
    body = pc.if_else(pc.equal(pc.binary_length(texts), 0), nothing, body)
    parts = pc.split_pattern(body, b" ")
    return parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Lattice:
    """Matches of pieces in chunks, ordered by where they start in their chunk.

    ``data`` holds the chunks, each closed by ``END``; a position in it is a node,
    and a chunk's path leads from its first byte to its ``END``.
    """

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    chunk: np.ndarray  # of each match
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray  # -1: one character without a piece of its own
    steps: np.ndarray  # matches from steps[i] to steps[i + 1] start equally far from their chunk's beginning


def lattice(vocabulary: Vocabulary, words: list[bytes]) -> Lattice:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(sizes + 1) - 1
    first = last - sizes
    data = np.frombuffer(bytes([END]).join(words) + bytes([END]), np.uint8)
    starts = np.flatnonzero(((data & 0xC0) != 0x80) & (data != END))
    width = np.diff(np.append(starts, len(data)))
    width -= data[starts + width - 1] == END

    base, check, value = vocabulary.base, vocabulary.check, vocabulary.value
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    whole = np.zeros(len(data), bool)  # the character here is a piece
    begin, at, state, size = starts, starts, np.zeros(len(starts), np.int64), width
    while len(at):
        following = base[state] + data[at]
        matched = np.flatnonzero(check[following] == state)
        begin, at, state, size = begin[matched], at[matched] + 1, following[matched], size[matched]
        piece = value[state]
        hit = np.flatnonzero(piece >= 0)
        begins, ends = begin[hit], at[hit]
        found.append((begins, ends, piece[hit]))
        whole[begins[ends - begins == size[hit]]] = True
    unknown = np.flatnonzero(~whole[starts])
    found.append((starts[unknown], starts[unknown] + width[unknown], np.full(len(unknown), -1, np.int32)))
    start, end, piece = (np.concatenate(x) for x in zip(*found))
    chunk = np.searchsorted(last, start)
    step = start - first[chunk]
    if len(step) and step.max() < 65536:
        step = step.astype(np.uint16)  # sorted by counting
    order = np.argsort(step, kind="stable")
    step = step[order].astype(np.int64)
    steps = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(step))
    return Lattice(data, first, last, chunk[order], start[order], end[order], piece[order].astype(np.int64), steps)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of ``range(start, start + size)``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + sizes, sizes) + np.arange(total)


class ChunkStore:
    """What was worked out per chunk, kept for a bounded number of chunks."""

    def __init__(self, work) -> None:
        self.work = work  # list of chunks -> (values, sizes)
        self.clear()

    def clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.held = 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values = np.zeros(1 << 16, np.int32)

    def look_up(self, words: pa.Array) -> np.ndarray:
        """The numbers of chunks in ``starts`` and ``sizes``, which point into ``values``."""
        encoded = pc.dictionary_encode(words)
        distinct = encoded.dictionary.to_pylist()
        get = self.codes.get
        codes = np.fromiter((get(word, -1) for word in distinct), np.int64, len(distinct))
        new = np.flatnonzero(codes < 0)
        if len(new):
            if self.codes and len(self.codes) + len(new) > CHUNKS_KEPT:
                self.clear()
                new = np.arange(len(distinct))
            added = [distinct[i] for i in new]
            values, sizes = self.work(added)
            codes[new] = np.arange(len(self.codes), len(self.codes) + len(new))
            self.codes.update(zip(added, codes[new].tolist()))
            self._append(values, sizes)
        return codes[encoded.indices.to_numpy()]

    def _append(self, values: np.ndarray, sizes: np.ndarray) -> None:
        needed = self.held + len(values)
        if needed > len(self.values):
            self.values = np.concatenate((self.values[: self.held], np.zeros(2 * needed - self.held, np.int32)))
        self.values[self.held : needed] = values
        self.starts = np.append(self.starts, self.held + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.held = needed
