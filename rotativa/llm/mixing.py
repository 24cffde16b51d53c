"""Mixing sources to target weights by Sainte-Laguë apportionment, in SQL functions only.

The mix has a number of blocks of equally many words.  Blocks go to sources by
the highest quotients ``target / (2 k + 1)``, and those of a source to its
shards by the highest quotients of the shards' words, so that every shard has
an integer quota.  A shard's documents stand in a seeded order; its blocks are
taken from the front of that stream, and from the front again once it has
ended.  All but one document of a shard is thus taken a whole number of times.

The last block of a source is cut or lengthened to the words its target leaves,
in the source's largest shard, so a source far smaller than a block keeps its words.

A quotient is compared only near the cut: seats that a group wins for certain
follow from the divisor of its mean block, and the margin around them is
proved in ``apportion``.  Nothing is listed per block.

Nulls and ties: a NULL source is a source of its own and the last one, a NULL
text has no words, documents without words are never taken, equal quotients go
to the earlier source or shard, equal rows get interchangeable results, and an
empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rotativa.llm.common import boxed, sized, small, word_count
from rotativa.session import discard, reading, stored

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 64
ROWS_PER_SHARD = 4096
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per source: place in code point order, words and the words the mix should hold.

    A source stops at ``cap`` times its words.  With the sources in the order in
    which they reach that limit, the level at which the others share the rest
    follows from running sums.  One row per source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_at", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    repeating = F.array(*(F.lit(w) for w in weights))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(repeating, F.col("place") % len(weights)).cast("long"))
        .withColumn("limit_at", F.col("source_size") * float(cap) / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(whole))
        .withColumn("all_weight", F.sum("weight").over(whole))
        .withColumn("words_before", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "level", (F.col("all_words") - F.col("words_before")) / (F.col("all_weight") - F.col("weight_before"))
        )
        # the level where the first source keeps below its limit holds for all after it
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("limit_at"), F.struct("limit_at", "place", "level"))).over(whole)["level"])
        .withColumn("target", F.least(F.col("source_size") * float(cap), F.col("weight") * F.col("level")))
        .withColumn("target", F.coalesce("target", F.col("source_size") * float(cap)))
        .select("source", "place", "source_size", "documents", "target")
    )


def apportion(rows: DataFrame, group: list[str], order: str, share: str, seats: Column, name: str) -> DataFrame:
    """Sainte-Laguë: a group's seats go to its rows by the highest quotients of their shares.

    With n rows, shares summing to T and s seats, the divisor T / s gives each
    row ``round(share * s / T)`` seats, which misses the total by n / 2 at most.
    The divisor that fits therefore changes no row by more than
    ``1.5 n share / T + 1`` seats: only those are ranked.
    """
    of_group = Window.partitionBy(*group)
    total, count = F.sum(share).over(of_group), F.count("*").over(of_group)
    near = F.floor(F.col(share) * F.col("_seats") / F.col("_total") + 0.5)
    margin = F.ceil(F.col("_count") * 1.5 * F.col(share) / F.col("_total")) + 1
    sure = (
        rows.withColumn("_seats", seats)
        .withColumn("_total", total.cast("double"))
        .withColumn("_count", count)
        .withColumn("_near", F.when(F.col("_total") > 0, near).otherwise(0).cast("long"))
        .withColumn("_margin", F.when(F.col("_total") > 0, margin).otherwise(0).cast("long"))
        .withColumn("_sure", F.greatest(F.col("_near") - F.col("_margin"), F.lit(0)))
        .withColumn("_open", F.col("_seats") - F.sum("_sure").over(of_group))
    )
    ranked = sure.withColumn("_seat", F.explode(F.sequence("_sure", F.col("_near") + F.col("_margin")))).withColumn(
        "_rank",
        F.row_number().over(
            Window.partitionBy(*group).orderBy((F.col(share) / (F.col("_seat") * 2 + 1)).desc(), order, "_seat")
        ),
    )
    won = F.sum(F.when((F.col("_rank") <= F.col("_open")) & (F.col(share) > 0), 1).otherwise(0))
    kept = [c for c in rows.columns if c not in group]
    return (
        ranked.groupBy(*group, order)
        .agg(*(F.first(c).alias(c) for c in kept if c != order), F.first("_sure").alias("_sure"), won.alias("_won"))
        .withColumn(name, F.col("_sure") + F.col("_won"))
        .select(*rows.columns, name)
    )


def mix(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    rows_per_shard: int = ROWS_PER_SHARD,
    seed: str = SEED,
) -> DataFrame:
    """Rows (doc_id, source, size, ...) with source_size, target, shard and the words taken of each.

    ``sizes`` is read several times: give a stored table.  The number of shards
    of a source follows its rows, so that a frequent source is spread as evenly
    as any other.
    """
    spark = sizes.sparkSession
    targets = stored(source_targets(sizes, weights, cap), "mix-targets")
    many = targets.count()
    all_words = F.sum("source_size").over(Window.partitionBy())
    blocks = F.floor((all_words * 2 + block_words) / F.lit(2 * block_words)).cast("long")
    seated = apportion(targets.withColumn("_all", F.lit(0)), ["_all"], "place", "target", blocks, "blocks").drop("_all")
    rest = F.floor(F.col("target") + 0.5).cast("long") - F.col("blocks") * block_words
    sources = stored(seated.withColumn("rest", rest), "mix-sources")

    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    spread = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    placed = stored(
        sizes.withColumn("_key", key)
        .join(small(sources.withColumnRenamed("source", "_source"), many), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("shard", F.floor(spread * F.ceil(F.col("documents") / rows_per_shard)).cast("long")),
        "mix-placed",
    )
    shards = (
        placed.groupBy("place", "shard")
        .agg(F.sum("size").alias("shard_size"), F.first("blocks").alias("blocks"), F.first("rest").alias("rest"))
        .withColumn("largest", F.min(F.struct(-F.col("shard_size"), "shard")).over(Window.partitionBy("place"))["shard"])
        .select("place", "shard", "shard_size", "blocks", F.when(F.col("shard") == F.col("largest"), F.col("rest")).otherwise(0).alias("rest"))
    )
    quotas, shard_count = sized(apportion(shards, ["place"], "shard", "shard_size", F.col("blocks"), "quota"), "mix-quotas")
    in_shard = Window.partitionBy("place", "shard").orderBy("_key", F.col("doc_id").asc_nulls_last(), "size")
    stream = placed.withColumn("_before", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    quota = quotas.select(
        F.col("place").alias("_place"),
        F.col("shard").alias("_shard"),
        "shard_size",
        F.least(F.greatest(F.col("quota") * block_words + F.col("rest"), F.lit(0)), F.col("shard_size") * cap).alias("_words"),
    )
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("_words") / F.col("shard_size"))).otherwise(0).cast("long")
    left = F.col("_words") - F.col("_passes") * F.col("shard_size")
    part = F.least(F.greatest(left - F.col("_before"), F.lit(0)), F.col("size"))
    return (
        stream.join(small(quota, shard_count), (F.col("place") == F.col("_place")) & (F.col("shard") == F.col("_shard")))
        .withColumn("_passes", passes)
        .withColumn("taken", (F.col("_passes") * F.col("size") + part).cast("long"))
        .select(*sizes.columns, "source_size", "target", "shard", "taken")
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each as often as its words are taken, to the nearest whole number."""
    rows = boxed(docs, "mix-documents")
    sizes = stored(rows.select("_row", "doc.doc_id", "doc.source", word_count(F.col("doc.text")).alias("size")), "mix-sizes")
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    chosen = mix(sizes, **options).select("_row", copies.alias("copies")).where("copies > 0")
    chosen, count = sized(chosen, "mix-chosen")
    discard(sizes)
    copied = rows.join(small(chosen, count, 500_000), "_row").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return reading(copied.select("doc.*"), rows, chosen)


ORACLE = rf"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), named AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS documents,
           row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
    FROM sizes GROUP BY source
), weighed AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM named
), limits AS (
    SELECT *, source_size * CAST({CAP} AS DOUBLE) / weight AS limit_at FROM weighed
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(source_size * {CAP}) OVER b, 0) AS DOUBLE)
              / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
    FROM limits WINDOW b AS (ORDER BY limit_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, place, source_size, documents, least(source_size * CAST({CAP} AS DOUBLE),
           weight * (SELECT arg_min(level, place + 0.0) FROM (SELECT level, row_number() OVER (ORDER BY limit_at, place) AS place
                     FROM levels WHERE level <= limit_at))) AS target
    FROM levels
), house AS (
    SELECT *, CAST(floor((sum(source_size) OVER () * 2 + {BLOCK_WORDS}) / {2 * BLOCK_WORDS}.0) AS BIGINT) AS seats,
           CAST(sum(target) OVER () AS DOUBLE) AS total, count(*) OVER () AS many FROM targets
), near AS (
    SELECT *, CAST(floor(target * seats / total + 0.5) AS BIGINT) AS n, CAST(ceil(many * CAST(1.5 AS DOUBLE) * target / total) + 1 AS BIGINT) AS m
    FROM house
), sure AS (SELECT *, greatest(n - m, 0) AS s, seats - sum(greatest(n - m, 0)) OVER () AS open FROM near),
seated AS (
    SELECT *, row_number() OVER (ORDER BY target / (seat * 2 + 1) DESC, place, seat) AS rank
    FROM (SELECT *, unnest(generate_series(s, n + m)) AS seat FROM sure)
), sources AS (
    SELECT place, any_value(source) AS source, any_value(source_size) AS source_size, any_value(documents) AS documents,
           any_value(target) AS target, any_value(s) + count(*) FILTER (rank <= open AND target > 0) AS blocks
    FROM seated GROUP BY place
), placed AS (
    SELECT d.doc_id, d.size, k.*, md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':{SEED}') AS key,
           CAST(floor(CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':{SEED}'), 1, 8) AS BIGINT) AS DOUBLE)
                      / 4294967296.0 * ceil(k.documents / CAST({ROWS_PER_SHARD} AS DOUBLE))) AS BIGINT) AS shard
    FROM sizes d JOIN sources k ON d.source IS NOT DISTINCT FROM k.source
), shards AS (
    SELECT place, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(blocks) AS seats,
           CAST(floor(any_value(target) + 0.5) AS BIGINT) - any_value(blocks) * {BLOCK_WORDS} AS rest
    FROM placed GROUP BY place, shard
), near2 AS (
    SELECT *, CAST(sum(shard_size) OVER g AS DOUBLE) AS total, count(*) OVER g AS many,
           CASE WHEN row_number() OVER (PARTITION BY place ORDER BY shard_size DESC, shard) = 1 THEN rest ELSE 0 END AS more
    FROM shards WINDOW g AS (PARTITION BY place)
), counted2 AS (
    SELECT *, CASE WHEN total > 0 THEN CAST(floor(CAST(shard_size * seats AS DOUBLE) / total + 0.5) AS BIGINT) ELSE 0 END AS n,
           CASE WHEN total > 0 THEN CAST(ceil(many * CAST(1.5 AS DOUBLE) * shard_size / total) + 1 AS BIGINT) ELSE 0 END AS m
    FROM near2
), sure2 AS (
    SELECT *, greatest(n - m, 0) AS s, seats - sum(greatest(n - m, 0)) OVER (PARTITION BY place) AS open FROM counted2
), seated2 AS (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY CAST(shard_size AS DOUBLE) / (seat * 2 + 1) DESC, shard, seat) AS rank
    FROM (SELECT *, unnest(generate_series(s, n + m)) AS seat FROM sure2)
), quotas AS (
    SELECT place, shard, any_value(shard_size) AS shard_size, least(greatest((any_value(s) + count(*) FILTER (rank <= open AND shard_size > 0))
           * {BLOCK_WORDS} + any_value(more), 0), any_value(shard_size) * {CAP}) AS words
    FROM seated2 GROUP BY place, shard
), streamed AS (
    SELECT p.*, q.shard_size, q.words, CASE WHEN q.shard_size > 0 THEN q.words // q.shard_size ELSE 0 END AS passes,
           sum(p.size) OVER (PARTITION BY p.place, p.shard ORDER BY p.key, p.doc_id NULLS LAST, p.size
                             ROWS UNBOUNDED PRECEDING) - p.size AS before
    FROM placed p JOIN quotas q ON p.place = q.place AND p.shard = q.shard
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + least(greatest(words - passes * shard_size - before, 0), size) AS BIGINT) AS taken
FROM streamed
"""
