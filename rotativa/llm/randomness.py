"""Secrets in texts: known shapes, and strings that a battery of randomness tests takes for random, in SQL functions only.

Known shapes (``BASE``) are assignments of a password, secret, token or key,
access key ids, and long hexadecimal strings.  Every other stretch of at least
``LEAST`` letters, digits and encoding signs is a candidate.  Its encoding is the
smallest alphabet that holds it; a plain number is none.  The symbols' places in
the alphabet are tested three ways against independent uniform draws:

* chi-squared of the symbol counts (too uneven), by its mean and variance;
* the number of runs below and above the middle of the alphabet (both sides);
* the serial correlation of neighbours (both sides).

Fisher's method makes one p-value of the three, and a candidate below
``NOT_RANDOM`` is no secret.  That alone would let short words through, because a
short string gives the tests no power.  So a second question is asked: how likely
does ordinary text in that alphabet, of that length, come out as even?  Text has
an index of coincidence (``ALPHABETS``), from which mean and variance of
chi-squared follow for its length; that p-value falls with length for random
strings and stays high for text.  Benjamini and Hochberg's rule holds the
share of false discoveries at ``FALSE_DISCOVERIES``, for each encoding and each
octave of lengths by itself, over the candidates of all documents, so that many
short words do not hide long keys and long keys do not excuse short words.
P-values are rounded up to a grid for it, so its ranks are counts of a small
histogram and no candidate leaves its document.

A candidate that overlaps a known shape is already reported and left out.
Positions are code points.  NULL and empty texts have no spans; texts of any
length are read whole; repeated rows count as often as they stand; columns that
are not kept do not matter.  Running sums over the matches of a text go block by
block (``BLOCK``), so that a text of very many matches stays cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotativa.functions.values import once
from rotativa.session import reading, stored

LEAST = 20  # symbols of a candidate
NOT_RANDOM = 0.001  # combined p-value of the battery
FALSE_DISCOVERIES = 0.05
BLOCK = 64
GRID = 20  # steps of p-values per factor e
STEPS = 1400  # the smallest p-value is e^(-STEPS / GRID)


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the known shapes, and the characters of each that make it count
NAMES = "|".join(_any_case(name) for name in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED = 8
# for the other two, dropping shorter matches is the same as asking for the length, as nothing follows the characters
BASE = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}
KINDS = [*BASE, "random"]
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
# encoding -> (its symbols in order, index of coincidence of ordinary text written in it), the smallest alphabets first
ALPHABETS = {
    "hex": (DIGITS + "abcdef", 0.09),
    "HEX": (DIGITS + "ABCDEF", 0.09),
    "lower": (LOWER, 0.0655),
    "upper": (UPPER, 0.0655),
    "base32": (UPPER + "234567", 0.062),
    "base36": (DIGITS + LOWER, 0.062),
    "BASE36": (DIGITS + UPPER, 0.062),
    "base62": (DIGITS + UPPER + LOWER, 0.062),
    "base64": (UPPER + LOWER + DIGITS + "+/", 0.062),
    "base64url": (UPPER + LOWER + DIGITS + "-_", 0.062),
}
# fixed values: the tail of the normal distribution as a density times a polynomial
TAIL_SCALE = 0.2316419
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def tail(z: Column) -> Column:
    """The chance that a normal variable exceeds z."""
    t = 1 / (1 + F.abs(z) * TAIL_SCALE)
    polynomial = reduce(lambda held, factor: (held + F.lit(factor)) * t, reversed(TAIL), F.lit(0.0))
    above = F.exp(z * z * -0.5) * 0.3989422804014327 * polynomial
    return F.when(z >= 0, above).otherwise(1 - above)


def _starts(pieces: Column, matches: Column) -> Column:
    """Where each match starts: the lengths of what lies before it, summed block by block."""
    widths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))

    def summed(w: Column) -> Column:
        total = lambda first, count: F.aggregate(F.slice(w, first, count), F.lit(0), lambda held, x: held + x)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / BLOCK).cast("int")), lambda b: total(b * BLOCK + 1, F.lit(BLOCK)))
        begins = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("begins")),
            lambda held, x: F.struct((held["sum"] + x).alias("sum"), F.array_append(held["begins"], held["sum"]).alias("begins")),
        )["begins"]
        return once(
            begins,
            lambda begin: F.transform(
                w, lambda _, i: F.get(begin, F.floor(i / BLOCK).cast("int")) + total(F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)
            ),
        )

    return F.zip_with(once(widths, summed), F.slice(pieces, 1, F.size(matches)), lambda start, piece: start + F.length(piece))


def spans(text: Column, pattern: str) -> Column:
    """(start, end, value) of the leftmost matches that do not overlap."""

    def placed(matches: Column) -> Column:
        starts = once(F.split(text, pattern, -1), lambda pieces: _starts(pieces, matches))
        made = F.zip_with(starts, matches, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))
        return F.when(F.size(matches) > 0, made).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    return once(F.regexp_extract_all(text, F.lit(f"(?:{pattern})"), 0), placed)


def _of_kind(found: Column, number: int) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """(start, kind, end) of the known shapes, by start, then kind; a kind is its place in ``KINDS``."""
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        every = spans(text, pattern)
        if kind == "assign":
            every = F.filter(every, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGNED)
        found.append(_of_kind(every, number))
    return F.array_sort(F.concat(*found))


def _encoding(value: Column) -> Column:
    """The first alphabet that holds all symbols, or NULL; a plain number has none."""
    choice = F.when(value.rlike("^[0-9]+$"), None)
    for name, (symbols, _) in ALPHABETS.items():
        choice = choice.when(F.translate(value, symbols, "") == "", F.lit(name))
    return choice


def _tested(value: Column, encoding: Column) -> Column:
    """band and step of a candidate: its encoding and octave, and its p-value's place on the grid."""
    chosen = lambda number: reduce(lambda held, name: held.when(encoding == name, F.lit(ALPHABETS[name][number])), list(ALPHABETS)[1:], F.when(encoding == "hex", F.lit(ALPHABETS["hex"][number])))
    size = reduce(lambda held, name: held.when(encoding == name, F.lit(float(len(ALPHABETS[name][0])))), list(ALPHABETS)[1:], F.when(encoding == "hex", F.lit(16.0)))
    values = once(chosen(0), lambda symbols: F.transform(F.split(value, ""), lambda c: F.instr(symbols, c).cast("long")))
    long_ = lambda x: F.lit(x).cast("long")

    def counted(v: Column) -> Column:
        squares = F.aggregate(
            F.array_sort(v),
            F.struct(long_(0).alias("last"), long_(0).alias("run"), long_(0).alias("sum")),
            lambda h, x: F.struct(
                x.alias("last"),
                F.when(x == h["last"], h["run"] + 1).otherwise(long_(1)).alias("run"),
                (h["sum"] + F.when(x == h["last"], 2 * h["run"] + 1).otherwise(long_(1))).alias("sum"),
            ),
        )["sum"]
        walked = F.aggregate(
            v,
            F.struct(*(long_(0).alias(name) for name in ("last", "low", "turns", "sum", "square", "product"))),
            lambda h, x: F.struct(
                x.alias("last"),
                (h["low"] + (2 * x <= size).cast("long")).alias("low"),
                (h["turns"] + ((h["last"] > 0) & ((2 * x <= size) != (2 * h["last"] <= size))).cast("long")).alias("turns"),
                (h["sum"] + x).alias("sum"),
                (h["square"] + x * x).alias("square"),
                (h["product"] + x * h["last"]).alias("product"),
            ),
        )
        return F.struct(
            F.size(v).cast("double").alias("n"), F.element_at(v, 1).alias("first"), squares.cast("double").alias("squares"), walked.alias("w")
        )

    def judged(x: Column) -> Column:
        n, w = x["n"], x["w"]
        chi = x["squares"] * size / n - n
        z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        low = w["low"].cast("double")
        expected = low * (n - low) * 2 / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (w["turns"] + 1 - expected) / F.sqrt(spread)).otherwise(9.0)
        mean = w["sum"] / n
        squared = w["square"] - n * mean * mean
        together = w["product"] - mean * (w["sum"] * 2 - x["first"] - w["last"]) + (n - 1) * mean * mean
        z_serial = F.when(squared > 0, (together / squared + 1 / n) * F.sqrt(n)).otherwise(9.0)
        logs = F.ln(F.greatest(tail(z_chi), F.lit(1e-30)))
        for z in (z_runs, z_serial):
            logs = logs + F.ln(F.greatest(F.least(2 * tail(F.abs(z)), F.lit(1.0)), F.lit(1e-30)))
        battery = F.exp(logs) * (1 - logs + logs * logs / 2)
        excess = n * (size * chosen(1) - 1)
        as_text = tail(-(chi - (size - 1) - excess) / F.sqrt(2 * (size - 1) + 4 * excess))
        step = F.floor(F.ln(F.greatest(as_text, F.lit(1e-30))) * -GRID)
        return F.struct(
            F.concat(encoding, F.lit(" "), F.floor(F.log2(n)).cast("string")).alias("band"),
            F.when(battery < NOT_RANDOM, 0).otherwise(F.least(F.greatest(step, F.lit(0)), F.lit(STEPS))).cast("int").alias("step"),
        )

    return once(once(values, counted), judged)


def candidates(text: Column, base: Column) -> Column:
    """(start, end, band, step) of candidates that have an encoding and overlap no known shape."""

    def apart(every: Column) -> Column:
        return F.filter(
            F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _encoding(s["value"]).alias("encoding"))),
            lambda s: s["encoding"].isNotNull() & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )

    def judged(s: Column) -> Column:
        made = _tested(s["value"], s["encoding"])
        return once(made, lambda m: F.struct(s["start"].alias("start"), s["end"].alias("end"), m["band"].alias("band"), m["step"].alias("step")))

    return F.transform(apart(spans(text, CANDIDATE)), judged)


def discoveries(found: DataFrame) -> DataFrame:
    """(band, least): the step from which a band's candidates count, by Benjamini and Hochberg's rule; at most one row a band."""
    counts = found.select(F.explode("candidates").alias("c")).groupBy("c.band", "c.step").agg(F.count("*").alias("n"))
    band = Window.partitionBy("band")
    ranked = counts.select(
        "band", "step", F.sum("n").over(band).alias("all"), F.sum("n").over(band.orderBy(F.desc("step"))).alias("rank")
    )
    kept = ranked.where(F.exp(F.col("step") / -GRID) <= F.col("rank") / F.col("all") * FALSE_DISCOVERIES)
    return kept.groupBy("band").agg(F.min("step").alias("least"))


def secret_spans(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Kept columns and ``spans``: (start, kind, end) of all secrets, by start, then kind."""
    text = F.coalesce("text", F.lit(""))
    boxed = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), text.alias("text"))
    based = boxed.select("doc", "text", base_spans(F.col("text")).alias("base"))
    found = stored(based.select("doc", "base", candidates(F.col("text"), F.col("base")).alias("candidates")), "secret-candidates")
    # as many entries as there are encodings and octaves
    least = discoveries(found).agg(F.map_from_entries(F.collect_list(F.struct("band", "least"))).alias("least")).scalar()

    def added(entries: Column) -> Column:
        counted = F.filter("candidates", lambda c: (c["step"] > 0) & (c["step"] >= entries[c["band"]]))
        return _of_kind(counted, len(BASE))

    given = found.withColumn("least", least)
    result = given.select("doc.*", F.array_sort(F.concat("base", added(F.col("least")))).alias("spans"))
    return reading(result, found)


def _written(spans_: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def span_digests(found: DataFrame) -> DataFrame:
    """doc_id, numbers of the known shapes, the hash of their list, and the list of all spans."""
    many = (F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long").alias(f"n_{kind}") for n, kind in enumerate(BASE))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *many, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def _sql_tail(z: str) -> str:
    t = f"(1 / (1 + abs({z}) * {TAIL_SCALE}))"
    polynomial = "0.0"
    for factor in reversed(TAIL):
        polynomial = f"(({polynomial} + {factor}::DOUBLE) * {t})"
    above = f"exp(({z}) * ({z}) * -0.5) * 0.3989422804014327::DOUBLE * {polynomial}"
    return f"CASE WHEN ({z}) >= 0 THEN {above} ELSE 1 - {above} END"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def oracle() -> str:
    """The same as DuckDB SQL: every match and every symbol a row."""
    patterns = " UNION ALL ".join(
        f"SELECT {n} AS kind, '{_quoted(p)}' AS pattern" for n, p in enumerate([*BASE.values(), CANDIDATE])
    )
    alphabets = ", ".join(f"({n}, '{name}', '{s}', {ic}::DOUBLE)" for n, (name, (s, ic)) in enumerate(ALPHABETS.items()))
    z = {name: f"(z_{name})" for name in ("chi", "runs", "serial", "text")}
    matched = " UNION ALL ".join(
        f"SELECT id, {n} AS kind, regexp_extract_all(t, '(?:{_quoted(p)})') AS ms, string_split_regex(t, '{_quoted(p)}') AS ps FROM docs"
        for n, p in enumerate([*BASE.values(), CANDIDATE])
    )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({matched}),
pieces AS (
  SELECT id, kind, generate_subscripts(ms, 1) AS i, unnest(ms) AS v, unnest(ps[1:len(ms)]) AS p FROM matched WHERE len(ms) > 0),
placed AS (
  SELECT id, kind, v, sum(length(p) + length(v)) OVER (PARTITION BY id, kind ORDER BY i) - length(v) AS s FROM pieces),
every AS (SELECT id, kind, v, s::BIGINT AS s, (s + length(v))::BIGINT AS e FROM placed
  WHERE kind <> 0 OR length(regexp_extract(v, '{_quoted(ASSIGN)}', 2)) >= {ASSIGNED}),
base AS (SELECT id, kind, s, e FROM every WHERE kind < {len(BASE)}),
alphabets(number, encoding, symbols, ic) AS (VALUES {alphabets}),
fresh AS (
  SELECT c.*, row_number() OVER () AS token FROM every c WHERE kind = {len(BASE)} AND NOT regexp_full_match(v, '[0-9]+')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.id = c.id AND b.s < c.e AND c.s < b.e)),
encoded AS (
  SELECT f.*, a.encoding, a.symbols, a.ic, length(a.symbols)::DOUBLE AS k FROM fresh f
  JOIN alphabets a ON translate(f.v, a.symbols, '') = '' QUALIFY row_number() OVER (PARTITION BY token ORDER BY number) = 1),
letters AS (
  SELECT token, k, ic, encoding, generate_subscripts(string_split(v, ''), 1) AS i, unnest(string_split(v, '')) AS c, symbols FROM encoded),
valued AS (SELECT token, k, ic, encoding, i, instr(symbols, c)::BIGINT AS x FROM letters),
near AS (SELECT *, lag(x) OVER (PARTITION BY token ORDER BY i) AS b FROM valued),
sums AS (
  SELECT token, any_value(k) AS k, any_value(ic) AS ic, any_value(encoding) AS encoding, count(*)::DOUBLE AS n,
    count(*) FILTER (2 * x <= k)::DOUBLE AS low, count(*) FILTER (b IS NOT NULL AND (2 * x <= k) <> (2 * b <= k)) AS turns,
    sum(x)::BIGINT AS total, sum(x * x)::BIGINT AS square, sum(x * b)::BIGINT AS product, min_by(x, i) AS head, max_by(x, i) AS tail
  FROM near GROUP BY token),
squares AS (SELECT token, sum(c * c)::DOUBLE AS squares FROM (SELECT token, x, count(*) AS c FROM valued GROUP BY ALL) GROUP BY token),
first_ AS (
  SELECT *, squares * k / n - n AS chi, low * (n - low) * 2 / n + 1 AS expected, total / n AS mean, n * (k * ic - 1) AS excess
  FROM sums JOIN squares USING (token)),
second_ AS (
  SELECT *, (expected - 1) * (expected - 2) / (n - 1) AS spread, square - n * mean * mean AS squared,
    product - mean * (total * 2 - head - tail) + (n - 1) * mean * mean AS together FROM first_),
scores AS (
  SELECT *, (chi - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n) AS z_chi,
    CASE WHEN spread > 0 THEN abs((turns + 1 - expected) / sqrt(spread)) ELSE 9.0 END AS z_runs,
    CASE WHEN squared > 0 THEN abs((together / squared + 1 / n) * sqrt(n)) ELSE 9.0 END AS z_serial,
    -(chi - (k - 1) - excess) / sqrt(2 * (k - 1) + 4 * excess) AS z_text FROM second_),
logs AS (
  SELECT *, ln(greatest({_sql_tail(z['chi'])}, 1e-30)) + ln(greatest(least(2 * ({_sql_tail(z['runs'])}), 1.0), 1e-30))
    + ln(greatest(least(2 * ({_sql_tail(z['serial'])}), 1.0), 1e-30)) AS l, {_sql_tail(z['text'])} AS as_text FROM scores),
judged AS (
  SELECT token, encoding || ' ' || floor(log2(n))::INT AS band,
    CASE WHEN exp(l) * (1 - l + l * l / 2) < {NOT_RANDOM} THEN 0
      ELSE least(greatest(floor(ln(greatest(as_text, 1e-30)) * -{GRID}), 0), {STEPS})::INT END AS step FROM logs),
counts AS (SELECT band, step, count(*) AS n FROM judged GROUP BY ALL),
ranked AS (
  SELECT band, step, sum(n) OVER (PARTITION BY band) AS m, sum(n) OVER (PARTITION BY band ORDER BY step DESC) AS r FROM counts),
least_ AS (SELECT band, min(step) AS least FROM ranked WHERE exp(step / -{GRID}.0) <= r / m * {FALSE_DISCOVERIES} GROUP BY band),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT f.id, f.kind, f.s, f.e FROM judged JOIN least_ USING (band) JOIN fresh f USING (token) WHERE step > 0 AND step >= least),
named AS (SELECT id, kind, s, list_value({', '.join(f"'{kind}'" for kind in KINDS)})[kind + 1] || ':' || s || ':' || e AS w FROM spans)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(w, ',' ORDER BY s, kind) FILTER (kind < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg(w, ',' ORDER BY s, kind), '') AS spans
FROM docs LEFT JOIN named USING (id) GROUP BY id
"""


ORACLE = oracle()
