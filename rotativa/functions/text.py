"""Text expressions: cleaning, title case, text of markup."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from rotativa.fixed import UNWANTED_CHARACTERS, UNWANTED_CHARACTERS_LOWER

# Entities found in headline markup; the ampersand is last so that an escaped
# entity is decoded once only.
ENTITIES = (
    ("&lt", "<"),
    ("&gt", ">"),
    ("&quot", '"'),
    ("&#39", "'"),
    ("&nbsp", "\u00a0"),
    ("&copy", "©"),
    ("&middot", "·"),
    ("&amp", "&"),
)


def listed(characters: str) -> str:
    """A class of characters with its ranges and white space written out one by one: the same class.

    Java finds a listed character by one look into a table, while a class with
    ranges costs it more than ten times as much a character.
    """
    one_by_one = re.sub("([a-zA-Z])-([a-zA-Z])", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), characters)
    return one_by_one.replace(r"\s", " \t\n\x0b\f\r")


def clean_text(text: Column) -> Column:
    """Delete every character outside the alphabet and the space, then lower-case."""
    return F.lower(F.regexp_replace(text, listed(UNWANTED_CHARACTERS) + "+", ""))


def clean_text_collapsed(text: Column) -> Column:
    """Lower-case, delete outside the alphabet and white space, collapse and trim it."""
    letters = F.regexp_replace(F.lower(text), listed(UNWANTED_CHARACTERS_LOWER) + "+", "")
    return F.trim(F.regexp_replace(letters, r"\s+", " "))


# fixed values: the spaces that end a text without counting
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


@cache
def _folds() -> tuple[str, str]:
    """The characters that folding changes and what they become; those beyond the end of the second text go."""
    changed, removed = {}, []
    for code in (*range(0xD800), *range(0xE000, sys.maxunicode + 1)):
        character = chr(code)
        parts = unicodedata.normalize("NFD", character)
        base = unicodedata.normalize("NFC", "".join(c for c in parts if not unicodedata.category(c).startswith("M")))
        lower = base.lower() if len(base.lower()) == 1 else base
        if not lower:
            removed.append(character)
        elif lower != character:
            changed[character] = lower
    return "".join([*changed, *removed]), "".join(changed.values())


def folded(text: Column) -> Column:
    """The text without case, accents and spaces at its end; every other character stays what it is.

    ``ß`` and ``ss``, a ligature and its letters, wide and narrow forms differ.  Characters are folded
    one by one, so separate Hangul letters are not joined.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    letters = F.rtrim(F.translate(text, *_folds()), F.lit(SPACES))
    return F.when(ascii_only, F.rtrim(F.lower(text))).otherwise(letters)


def title_case(text: Column) -> Column:
    """Upper-case the letter after any non-letter and lower-case the others."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def decode_entities(text: Column) -> Column:
    """Decode entities; the semicolon may be missing before anything but a letter or digit."""
    for entity, character in ENTITIES:
        text = F.regexp_replace(text, entity + "(?:;|(?![0-9A-Za-z]))", character)
    return text


def node_text(markup: Column) -> Column:
    """Text of a piece of markup: its stripped text pieces joined without a separator."""
    pieces = F.split(markup, r"<[^>]*>")
    stripped = F.transform(
        pieces,
        lambda piece: F.regexp_replace(decode_entities(piece), r"^[\s\u00a0]+|[\s\u00a0]+$", ""),
    )
    return F.array_join(stripped, "")
