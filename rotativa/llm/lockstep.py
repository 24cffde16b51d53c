"""Alignment of two tokenizations of the same texts by lockstep merging.

Encoding A takes a space and the text, encoding B the text, to which it adds the
space itself.  Both are laid out as byte offsets, and a vector of pointer pairs
walks through all texts of a slice at once.  In each step every pair compares
the ends of its two tokens and advances the one that ends first; where both end,
the text is cut, the group since the last cut is emitted with all its A-B links,
and both advance.  Finished texts leave the vector.  A long text is entered at
several places where both encodings end, so that it does not keep the vector
waiting.

How many documents of the corpus hold a pair of ids linked is counted in blocks
of texts: a block names its distinct pairs once, with the documents that hold
them; the sums over blocks come back to each block by its names, and its
documents look their links up in them.  No document's links are shuffled, and no
pair is frequent among the rows, since a block has it once.

Texts that are NULL or empty, or that one encoding does not give back byte by
byte (B writes a marker U+2581 in a text as a space), have no tokens.  Texts of
any length are encoded whole; words repeat, so their tokens are kept for a
bounded number of distinct words.  Where spaces do not stand alone between words,
or the vocabularies have tokens across words, the whole text is encoded at once.
Equal rows are documents of their own; other columns, whatever their names, do
not matter.  The links of one group of distinct ids are held in one task: groups
end at the latest where both encodings begin a word.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotativa.llm.common import column_types, sized, small, text_slices
from rotativa.llm.pieces import MARK, ChunkStore, ranges
from rotativa.session import stored

JOINED = 100  # words encoded together
ENTERED = 512  # A tokens after which a text is entered anew
SMALL_GROUP = 64  # links of a group that are written out one by one
BLOCK_BYTES = 8_000_000  # text of a block
NAMED = 100_000  # pairs in one row of a block's names
SENT_ROWS = 500_000  # rows of counted pairs that may be sent to all tasks; more are joined by shuffling

DIFFERENT, APART = -1, -2  # in place of a chunk's number of tokens


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be printed, else the next free one."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


class ByteTable:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, values: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text give its bytes."""
        number = np.repeat(np.arange(len(texts)), counts)
        wide = np.fromiter(map(len, texts), np.int64, len(texts))
        same = np.bincount(number, self.sizes[values], len(texts)).astype(np.int64) == wide
        values = values[same[number]]
        made = self.data[ranges(self.starts[values], self.sizes[values])]
        given = np.frombuffer(b"".join([texts[i] for i in np.flatnonzero(same).tolist()]), np.uint8)
        wrong = np.flatnonzero(made != given)
        ends = np.cumsum(wide[same])
        same[np.flatnonzero(same)[np.searchsorted(ends, wrong, side="right")]] = False
        return same


class Encoders:
    """Both encodings of texts, each token with the number of its bytes."""

    def __init__(self, first: str, second: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks fill the cores
        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = byte_letters()
        a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            a_bytes[number] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_table, self.b_table = ByteTable(a_bytes), ByteTable(b_bytes)
        written = json.loads(first)
        cutting = written.get("pre_tokenizer") or {}
        self.by_words = (
            cutting.get("type") == "ByteLevel"
            and cutting.get("use_regex", True)
            and not written.get("normalizer")
            and not any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if not self.b.is_control(i))
        )
        self.store = ChunkStore(self._encoded)

    def _first(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A ids of a space and each text, and their numbers.

        Texts without white space are joined by line breaks, which are tokens by themselves then.
        """
        line = self.a.encode("\n", add_special_tokens=False).ids
        joined = np.fromiter((len(t.split()) == 1 and t == t.strip() for t in texts), bool, len(texts)) & (len(line) == 1)
        plain, other = np.flatnonzero(joined), np.flatnonzero(~joined)
        lines = [texts[i] for i in plain.tolist()]
        parts = ["".join(f" {t}\n" for t in lines[low : low + JOINED]) for low in range(0, len(lines), JOINED)]
        many = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        values = np.fromiter(chain.from_iterable(many), np.int32)
        ends = np.flatnonzero(values == line[0]) if len(plain) else plain
        ones = [e.ids for e in self.a.encode_batch_fast([" " + texts[i] for i in other.tolist()], add_special_tokens=False)]
        counts = np.zeros(len(texts), np.int64)
        counts[plain] = np.diff(ends, prepend=-1) - 1
        counts[other] = np.fromiter(map(len, ones), np.int64, len(ones))
        found = np.zeros(counts.sum(), np.int32)
        starts = np.cumsum(counts) - counts
        found[ranges(starts[plain], counts[plain])] = np.delete(values, ends)
        found[ranges(starts[other], counts[other])] = np.fromiter(chain.from_iterable(ones), np.int32)
        return found, counts

    def _encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each chunk the number of A tokens (or why it has none), the A tokens and the B tokens."""
        texts = [chunk.decode() for chunk in chunks]
        one, n_one = self._first(texts)
        lists = self.b.encode(texts, num_threads=1)
        n_other = np.fromiter(map(len, lists), np.int64, len(lists))
        other = np.fromiter(chain.from_iterable(lists), np.int32)
        whole = [b" " + chunk for chunk in chunks]
        same = self.a_table.spells(one, n_one, whole) & self.b_table.spells(other, n_other, whole)
        first = np.where(same, n_one, DIFFERENT)
        first[np.fromiter((not t or t != t.strip() for t in texts), bool, len(texts))] = APART
        sizes = 1 + n_one + n_other
        starts = np.cumsum(sizes) - sizes
        values = np.zeros(sizes.sum(), np.int32)
        values[starts] = first
        values[ranges(starts + 1, n_one)] = one
        values[ranges(starts + 1 + n_one, n_other)] = other
        return values, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A ids, B ids, and the numbers of each text's, for texts (binary, no NULL)."""
        import pyarrow.compute as pc

        parts = pc.split_pattern(texts, b" ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = self.store.look_up(parts.flatten())
        head = self.store.values[self.store.starts[codes]]
        text = np.repeat(np.arange(len(texts)), counts)
        whole = np.ones(len(texts), bool) if not self.by_words else np.bincount(text[head == APART], minlength=len(texts)) > 0
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        none = (np.bincount(text[head == DIFFERENT], minlength=len(texts)) > 0) | empty
        plain = ~(whole | none)[text]
        codes, head, text = codes[plain], head[plain].astype(np.int64), text[plain]
        starts, sizes = self.store.starts[codes] + 1, self.store.sizes[codes] - 1
        a, b = self.store.values[ranges(starts, head)], self.store.values[ranges(starts + head, sizes - head)]
        n_a = np.bincount(text, head, len(texts)).astype(np.int64)
        n_b = np.bincount(text, sizes - head, len(texts)).astype(np.int64)
        late = np.flatnonzero(whole & ~empty)
        if len(late):
            a, b = np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1])
            for i in late.tolist():
                chunk = texts[i].as_py()
                one = self.a.encode(" " + chunk.decode(), add_special_tokens=False).ids
                other = self.b.encode(chunk.decode())
                joined = [b"".join([t.tokens[x] for x in ids]) for t, ids in ((self.a_table, one), (self.b_table, other))]
                if joined != [b" " + chunk] * 2:
                    one, other = [], []
                a[i], b[i] = np.array(one, np.int32), np.array(other, np.int32)
                n_a[i], n_b[i] = len(one), len(other)
            a, b = np.concatenate(a), np.concatenate(b)
        return a, b, n_a, n_b


@lru_cache(maxsize=2)
def load_encoders(first: str, second: bytes) -> Encoders:
    return Encoders(first, second)


def merged(a_end: np.ndarray, b_end: np.ndarray, n_a: np.ndarray) -> np.ndarray:
    """Groups (first A, last A, first B, last B) of texts that lie one after the other; ends are byte offsets.

    ``n_a`` has the number of A tokens of each text that has any.
    """
    begins = np.cumsum(n_a) - n_a
    more = (n_a - 1) // ENTERED
    entered = np.repeat(begins, more) + ENTERED * (ranges(np.ones(len(n_a), np.int64), more))
    at = np.searchsorted(b_end, a_end[entered - 1])
    entered = entered[b_end[at] == a_end[entered - 1]]  # both encodings end before it
    a = np.sort(np.concatenate((begins, entered)))
    b = np.searchsorted(b_end, np.where(a > 0, a_end[a - 1], 0), side="right")
    stop = np.append(a[1:], len(a_end))[: len(a)]
    first_a, first_b = a, b
    emitted = [np.zeros((4, 0), np.int64)]
    while len(a):
        one, other = a_end[a], b_end[b]
        cut = one == other
        emitted.append(np.stack((first_a[cut], a[cut], first_b[cut], b[cut])))
        a, b = a + (one <= other), b + (other <= one)
        first_a, first_b = np.where(cut, a, first_a), np.where(cut, b, first_b)
        walking = a < stop
        if not walking.all():
            a, b, stop, first_a, first_b = (x[walking] for x in (a, b, stop, first_a, first_b))
    groups = np.concatenate(emitted, axis=1)
    return groups[:, np.argsort(groups[0], kind="stable")]


def linked_pairs(a: np.ndarray, b: np.ndarray, groups: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text and pair as one number, times linked), each once, in order; ``text`` of each group, ``width`` ids of B."""
    first_a, last_a, first_b, last_b = groups
    many_a, many_b = last_a - first_a + 1, last_b - first_b + 1
    few = many_a * many_b <= SMALL_GROUP
    wide, many = many_b[few], (many_a * many_b)[few]
    turn = ranges(np.zeros(len(many), np.int64), many)
    wide = np.repeat(wide, many)
    one = a[np.repeat(first_a[few], many) + turn // wide].astype(np.int64)
    other = b[np.repeat(first_b[few], many) + turn % wide]
    key = np.sort((np.repeat(text[few], many) << 32) | (one * width + other))
    new = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[new], np.diff(np.append(new, len(key)))
    large = np.flatnonzero(~few).tolist()
    if large:
        keys, all_times = [key], [times]
        for g in large:
            ones, c = np.unique(a[first_a[g] : last_a[g] + 1], return_counts=True)
            others, d = np.unique(b[first_b[g] : last_b[g] + 1], return_counts=True)
            keys.append(((text[g] << 32) | (ones.astype(np.int64)[:, None] * width + others)).ravel())
            all_times.append((c[:, None] * d).ravel())
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.zeros(len(key), np.int64)
        np.add.at(times, place, np.concatenate(all_times))
    return key, times


class Aligned:
    """The tokens and groups of the texts of a slice."""

    def __init__(self, encoders: Encoders, texts: pa.Array) -> None:
        self.a, self.b, self.n_a, self.n_b = encoders.encode(texts)
        a_end, b_end = np.cumsum(encoders.a_table.sizes[self.a]), np.cumsum(encoders.b_table.sizes[self.b])
        self.groups = merged(a_end, b_end, self.n_a[self.n_a > 0])
        self.text = np.searchsorted(np.cumsum(self.n_a), self.groups[0], side="right")
        self.n_groups = np.bincount(self.text, minlength=len(texts))
        links = (self.groups[1] - self.groups[0] + 1) * (self.groups[3] - self.groups[2] + 1)
        sums = np.concatenate(([0], np.cumsum(links)))
        ends = np.cumsum(self.n_groups)
        self.n_links = sums[ends] - sums[ends - self.n_groups]

    def lists(self) -> list[str]:
        """Of each text ``a1,a2|b1;a3|b2,b3``: the ids of its groups in order."""
        first_a, last_a, first_b, last_b = self.groups
        group_a = np.repeat(np.arange(len(first_a)), last_a - first_a + 1)
        group_b = np.repeat(np.arange(len(first_b)), last_b - first_b + 1)
        kinds, names = _names(max(int(self.a.max(initial=0)), int(self.b.max(initial=0))) + 1)
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        at_a, at_b = np.arange(len(self.a)), np.arange(len(self.b))
        code[at_a + first_b[group_a]] = self.a + kinds * (at_a == last_a[group_a])
        code[at_b + last_a[group_b] + 1] = self.b + kinds * 2 * (at_b == last_b[group_b])
        ends = np.cumsum(self.n_a + self.n_b)
        code = code.tolist()
        return ["".join([names[c] for c in code[low:high]])[:-1] for low, high in zip([0, *ends[:-1].tolist()], ends.tolist())]


@lru_cache(maxsize=2)
def _numbered(kinds: int) -> list[str]:
    return [f"{i}{mark}" for mark in ",|;" for i in range(kinds)]


def _names(least: int) -> tuple[int, list[str]]:
    kinds = 1 << max(16, (least - 1).bit_length())
    return kinds, _numbered(kinds)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))


def shared_encoders(spark: SparkSession, paths: tuple[str, str] | None):
    """Both vocabulary files for all tasks: their size does not depend on the corpus."""
    first, second = paths or default_vocabularies()
    with open(first, encoding="utf-8") as one, open(second, "rb") as other:
        return spark.sparkContext.broadcast((one.read(), other.read()))


def alignments(docs: DataFrame, keep: tuple[str, ...], paths: tuple[str, str] | None = None) -> DataFrame:
    """Kept columns with a_ids, b_ids, and for every cut how many tokens of each there are before it."""
    shared = shared_encoders(docs.sparkSession, paths)

    def run(batches):
        encoders = load_encoders(*shared.value)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                found = Aligned(encoders, texts)
                before = [np.repeat(np.cumsum(n) - n, found.n_groups) for n in (found.n_a, found.n_b)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in keep),
                        _lists(found.a, found.n_a, pa.int32()),
                        _lists(found.b, found.n_b, pa.int32()),
                        _lists(found.groups[1] + 1 - before[0], found.n_groups, pa.int32()),
                        _lists(found.groups[3] + 1 - before[1], found.n_groups, pa.int32()),
                    ],
                    names=[*keep, "a_ids", "b_ids", "a_cuts", "b_cuts"],
                )

    made = [f"{name} ARRAY<INT>" for name in ("a_ids", "b_ids", "a_cuts", "b_cuts")]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(column_types(docs, *keep) + made))


FOUND = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(batches, shared, schema: pa.Schema):
    """Documents with the places of their pairs among their block's, and the pairs of each block."""
    encoders = load_encoders(*shared.value)
    width = len(encoders.b_table.tokens)
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    made, held, taken = 0, [], 0

    def flush():
        keys = np.concatenate([pairs for _, _, pairs, _, _ in held])
        names, place, holders = np.unique(keys, return_inverse=True, return_counts=True)
        block = (task << 32) + made
        begin = 0
        for part, columns, pairs, times, counts in held:
            yield batch_of(
                len(counts),
                block=np.full(len(counts), block),
                doc=part,
                **columns,
                places=_lists(place[begin : begin + len(pairs)], counts, pa.int32()),
                times=_lists(times, counts, pa.int64()),
            )
            begin += len(pairs)
        for low in range(0, len(names), NAMED):
            part = slice(low, low + NAMED)
            many = np.array([len(names[part])])
            yield batch_of(1, block=[block], low=[low], pairs=_lists(names[part], many, pa.int64()), holders=_lists(holders[part], many, pa.int64()))

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type)
                for f in schema
            ],
            schema=schema,
        )

    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            found = Aligned(encoders, texts)
            key, times = linked_pairs(found.a, found.b, found.groups, found.text, width)
            digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in found.lists()]
            columns = {name: getattr(found, name) for name in FOUND} | {"groups_sha256": digests}
            counts = np.bincount(key >> 32, minlength=len(texts))
            held.append((part.column("doc"), columns, key & 0xFFFFFFFF, times, counts))
            taken += int(texts.nbytes)
            if taken >= BLOCK_BYTES:
                yield from flush()
                made, held, taken = made + 1, [], 0
    if held:
        yield from flush()


def _looked_up(left: pa.Table, right: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's documents with the counts of their links."""
    left = left.combine_chunks()
    size = left.num_rows
    at = right.column("at").to_numpy()
    documents, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    documents[at] = right.column("documents").to_numpy()
    best[at] = right.column("best").to_numpy(zero_copy_only=False)
    places, times = (left.column(name).combine_chunks() for name in ("places", "times"))
    ends = np.cumsum(places.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    place, time = places.flatten().to_numpy(), times.flatten().to_numpy()

    def total(values: np.ndarray) -> pa.Array:
        sums = np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], ends))]
        return pa.array(np.diff(sums), pa.int64())

    doc = left.column("doc").combine_chunks()
    columns = {"doc": doc} | {name: left.column(name) for name in (*FOUND, "groups_sha256")}
    columns |= {"n_best": total(time * best[place]), "count_sum": total(time * documents[place])}
    return pa.table([columns[f.name] for f in schema], schema=schema) if size else schema.empty_table()


def counted_alignments(docs: DataFrame, keep: tuple[str, ...], paths: tuple[str, str] | None = None) -> DataFrame:
    """Kept columns with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A link's count is the number of documents (rows) that hold its two ids linked;
    ``n_best`` counts the links with the highest count of their A id, ``count_sum``
    sums the counts.  The hash is that of the groups' list, '' without tokens.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    shared = shared_encoders(spark, paths)
    boxed = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), "text")
    numbers = ", ".join(f"{name} BIGINT" for name in FOUND)
    own = f"doc {boxed.schema['doc'].dataType.simpleString()}, {numbers}, groups_sha256 STRING"
    layout = f"block BIGINT, {own}, places ARRAY<INT>, times ARRAY<BIGINT>, low BIGINT, pairs ARRAY<BIGINT>, holders ARRAY<BIGINT>"
    arrow = lambda written: to_arrow_schema(spark.createDataFrame([], written).schema)
    blocks = stored(boxed.mapInArrow(partial(_blocks, shared=shared, schema=arrow(layout)), layout), "aligned-blocks")

    named = blocks.where("pairs IS NOT NULL").select("block", "low", F.posexplode(F.arrays_zip("pairs", "holders")).alias("i", "x"))
    named = named.select("block", (F.col("low") + F.col("i")).cast("int").alias("at"), F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    counts = named.groupBy("pair").agg(F.sum("holders").alias("documents"))
    with open((paths or default_vocabularies())[1], "rb") as file:
        import sentencepiece

        width = sentencepiece.SentencePieceProcessor(model_proto=file.read()).get_piece_size()
    counts = stored(counts.withColumn("a", F.expr(f"pair div {width}")), "aligned-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # a row per id of the vocabulary at most
    judged, count = sized(
        counts.join(F.broadcast(most), "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best")), "aligned-judged"
    )
    told = named.join(small(judged, count, SENT_ROWS), "pair").select(F.col("block").alias("of_block"), "at", "documents", "best")
    rows = blocks.where("doc IS NOT NULL").select("block", "doc", *FOUND, "groups_sha256", "places", "times")
    result = f"{own}, n_best BIGINT, count_sum BIGINT"
    found = rows.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(partial(_looked_up, schema=arrow(result)), result)
    return found.select("doc.*", *FOUND, "n_best", "count_sum", "groups_sha256")
