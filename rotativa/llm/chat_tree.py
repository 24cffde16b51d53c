"""Chat formatting with a prefix tree: what conversations share is written once.

A conversation is a path of turns, and a turn is known by a digest of itself and
all turns before it.  Conversations are sorted by the digests along their paths, so
that those with the same beginning are neighbours and the order is that of a
depth-first walk.  A sorted range of them is a pack: a stream of characters in which
a turn is written when the path comes to it and taken over by all following
conversations that begin alike.  Ranges are cut by path and conversation, so that a
beginning that very many conversations share is spread over packs and written once
in each.

Each turn of each conversation gives one row: where it stands in its pack, its text
if it is written there for the first time, the position id of its first character
(ids count on from there, as in the conversation read alone), the intervals of the
stream that it sees besides itself, and the interval of assistant text, on which a
loss is taken.

The template is ``<|turn|>role<|text|>text<|end|>``.  In roles and texts a
``<``, any number of backslashes and a ``|`` get one backslash more, which no
marker has, so the texts can be read back whatever they hold.

A conversation is never gathered into a row.  Its turns pass one task in their
order, as digests and texts are those of a sequence; the task holds digests and
places of one path, a few hundred bytes a turn, and of texts, however long, those of
the batch at hand.  The sort key has the digests of the first ``KEY_TURNS`` turns and
of every doubling beyond, so it is bounded; conversations that part between two of
the later ones still share what they have in common with their neighbour.

Turns are in the order of ``turn`` (NULL first), then role, then text; repeated rows
are turns of their own, and NULL roles and texts are empty.  All rows without an id
are one conversation.  An empty table gives an empty one; other columns, whatever
their names, are left out.
"""

from __future__ import annotations

import hashlib
import re
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotativa.session import reading, stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"
CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<(\\*)\\\|")
TURNS = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)
PACK_CHARS = 4_000_000  # of the texts for one pack, on the average
KEY_TURNS = 256
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ROWS = (
    "pack INT, nth BIGINT, conv_id BIGINT, place BIGINT, shared BOOLEAN, start BIGINT, end BIGINT, text STRING, position BIGINT, "
    "context ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, loss_start BIGINT, loss_end BIGINT"
)
_ROWS = pa.schema(
    [
        ("pack", pa.int32()),
        ("nth", pa.int64()),
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("shared", pa.bool_()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("text", pa.string()),
        ("position", pa.int64()),
        ("context", _SPANS),
        ("loss_start", pa.int64()),
        ("loss_end", pa.int64()),
    ]
)
_DIGESTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("digest", pa.binary()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("key", pa.binary()),
    ]
)


def escape(text: str) -> str:
    return CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def _rows(batches, *names):
    """For each batch its rows as tuples of the named columns."""
    for batch in batches:
        yield zip(*(batch.column(name).to_pylist() for name in names))


def _digested(batches):
    """Number and digest of every turn, for turns that stand in order; a conversation's last turn has its sort key."""
    current, place, chain, key, last = None, 0, None, [], None
    for rows in _rows(batches, "conv_id", "role", "text"):
        made = []
        for conversation, role, text in rows:
            if last is not None:
                if conversation != current:
                    last["key"] = b"".join(key) + chain.digest()
                made.append(last)
            if last is None or conversation != current:
                current, place, chain, key = conversation, 0, hashlib.blake2b(digest_size=16), []
            for part in (role, text):
                data = part.encode()
                chain.update(len(data).to_bytes(8, "big"))
                chain.update(data)
            digest = chain.digest()
            if place < KEY_TURNS or place & (place - 1) == 0:
                key.append(digest[:8])
            last = {"conv_id": conversation, "place": place, "digest": digest, "role": role, "text": text, "key": None}
            place += 1
        yield pa.RecordBatch.from_pylist(made, schema=_DIGESTED)
    if last is not None:
        last["key"] = b"".join(key) + chain.digest()
        yield pa.RecordBatch.from_pylist([last], schema=_DIGESTED)


def _placed(batches):
    """Pack and number of every conversation of a sorted range."""
    pack, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        count = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([pack] * count, pa.int32()), pa.array(range(nth, nth + count), pa.int64())],
            names=["conv_id", "pack", "nth"],
        )
        nth += count


class Written(NamedTuple):
    """A turn of the current path: where it stands in the stream, and what it sees."""

    digest: bytes
    start: int
    end: int
    position: int
    context: tuple[tuple[int, int], ...]
    loss: tuple[int | None, int | None]


def _seen_after(turn: Written) -> tuple[tuple[int, int], ...]:
    """What the turn after this one sees."""
    *before, last = turn.context or ((turn.start, turn.start),)
    if last[1] == turn.start:
        return (*before, (last[0], turn.end))
    return (*before, last, (turn.start, turn.end))


def _walk(batches):
    """The packs out of the turns of their conversations, which stand in the order of packs, conversations and turns."""
    pack, at, nth, following = None, 0, None, False
    path: list[Written] = []
    for rows in _rows(batches, "pack", "nth", "conv_id", "place", "digest", "role", "text"):
        made = []
        for own_pack, own_nth, conversation, place, digest, role, text in rows:
            if own_pack != pack:
                pack, at, nth, path = own_pack, 0, None, []
            if own_nth != nth:
                nth, following = own_nth, True
            shared = following and place < len(path) and path[place].digest == digest
            content = ""
            if not shared:
                following = False
                del path[place:]
                head, body = TURN + escape(role) + TEXT, escape(text)
                content = head + body + END
                learnt = (at + len(head), at + len(head) + len(body)) if role == LEARNT else (None, None)
                before = path[-1] if path else None
                position = before.position + before.end - before.start if before else 0
                path.append(Written(digest, at, at + len(content), position, _seen_after(before) if before else (), learnt))
                at += len(content)
            turn = path[place]
            made.append(
                {
                    "pack": pack,
                    "nth": nth,
                    "conv_id": conversation,
                    "place": place,
                    "shared": shared,
                    "start": turn.start,
                    "end": turn.end,
                    "text": content,
                    "position": turn.position,
                    "context": [{"start": a, "end": b} for a, b in turn.context],
                    "loss_start": turn.loss[0],
                    "loss_end": turn.loss[1],
                }
            )
        yield pa.RecordBatch.from_pylist(made, schema=_ROWS)


def format_conversations(turns: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """One row per turn; within a partition rows stand in the order of packs, conversations and turns."""
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    ordered_turns = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    digested = stored(
        ordered_turns.mapInArrow(_digested, "conv_id BIGINT, place BIGINT, digest BINARY, role STRING, text STRING, key BINARY"),
        "chat-turns",
    )
    chars = digested.agg(F.sum(F.length("role") + F.length("text")).alias("n")).first()["n"] or 0
    packs = max(1, ceil(chars / pack_chars))
    ranged = digested.where("key IS NOT NULL").select("conv_id", "key").repartitionByRange(packs, "key", "conv_id")
    placed = stored(
        ranged.sortWithinPartitions("key", "conv_id").mapInArrow(_placed, "conv_id BIGINT, pack INT, nth BIGINT"), "chat-places"
    )
    named = placed.withColumnRenamed("conv_id", "_conv")
    joined = digested.drop("key").join(named, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    walked = joined.repartition("pack").sortWithinPartitions("pack", "nth", "place").mapInArrow(_walk, ROWS)
    return reading(walked, digested, placed)


def ordered(packs: DataFrame) -> DataFrame:
    """Stored packs in the order in which they were written, ready to be read back."""
    return packs.repartition("pack").sortWithinPartitions("pack", "nth", "place")


def read_turns(packs: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, learnt) read back from stored packs; a shared turn is read where it is written."""
    written = packs.where("NOT shared").select(F.col("pack").alias("_pack"), F.col("start").alias("_start"), F.col("text").alias("_text"))
    found = packs.join(written, (F.col("pack") == F.col("_pack")) & (F.col("start") == F.col("_start")))

    def read(batches):
        for rows in _rows(batches, "conv_id", "place", "_text", "start", "loss_start", "loss_end"):
            made = []
            for conversation, place, text, start, low, high in rows:
                role, said = _read(text)
                learnt = None if low is None else unescape(text[low - start : high - start])
                made.append((conversation, place, role, said, learnt))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("conv_id", "place", "role", "text", "learnt"), row)) for row in made],
                schema=pa.schema(
                    [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("learnt", pa.string())]
                ),
            )

    columns = found.select("conv_id", "place", "_text", "start", "loss_start", "loss_end")
    return columns.mapInArrow(read, "conv_id BIGINT, place BIGINT, role STRING, text STRING, learnt STRING")


def _read(written: str) -> tuple[str, str]:
    """Role and text of a turn as it is written."""
    role, text = TURNS.fullmatch(written).groups()
    return unescape(role), unescape(text)


class Read(NamedTuple):
    """What has been read of a path up to a turn."""

    start: int
    said: object
    learnt: object
    learnt_chars: int
    chars: int


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the conversations read back from formatted rows that still stand in the order of their packs."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))))

    def run(batches):
        current, conversation, count = None, None, 0
        path: list[Read] = []

        def whole() -> dict:
            end = path[count - 1]
            return dict(zip(names, (conversation, count, end.said.hexdigest(), end.learnt_chars, end.learnt.hexdigest(), end.chars)))

        for rows in _rows(batches, "pack", "nth", "conv_id", "place", "shared", "start", "text", "loss_start", "loss_end"):
            made = []
            for pack, nth, own, place, shared, start, text, low, high in rows:
                if (pack, nth) != current:
                    if current is not None:
                        made.append(whole())
                    if current is None or pack != current[0]:
                        path = []
                    current, conversation = (pack, nth), own
                count = place + 1
                if shared:
                    if path[place].start != start:
                        raise ValueError(f"pack {pack}: the turn at {start} is not on the path")
                    continue
                del path[place:]
                before = path[-1] if path else Read(0, hashlib.sha256(), hashlib.sha256(), 0, 0)
                role, content = _read(text)
                said, learnt, learnt_chars = before.said.copy(), before.learnt.copy(), before.learnt_chars
                said.update(f"{role}\n{content}\n".encode())
                if low is not None:
                    under = unescape(text[low - start : high - start])
                    learnt.update(under.encode())
                    learnt_chars += len(under)
                path.append(Read(start, said, learnt, learnt_chars, before.chars + len(text)))
            yield pa.RecordBatch.from_pylist(made, schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([whole()], schema=schema)

    digests = formatted.mapInArrow(
        run, "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT"
    )
    return reading(digests, *getattr(formatted, "working_tables", ()))
