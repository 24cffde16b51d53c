"""Distinct counts that can be merged: sketches per day and source.

A sketch is a few kilobytes however many rows it has seen, and the union of
sketches is the sketch of all their rows.  So the sketches of a day are made
once, when its rows are written, and the statistics of any range of days, or of
any set of sources, merge sketches and read no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: columns that are counted, and the names of their distinct counts
COUNTED = {"titular": "unique_titles", "enlace": "unique_links", "categoria": "unique_categories"}

PRECISION = 12  # a sketch has 2^12 cells
# relative standard error of an estimate by a sketch with so many cells, also of merged ones
STANDARD_ERROR = 1.04 / 2 ** (PRECISION / 2)


def daily_sketches(news: DataFrame, *group: str, counted: Mapping[str, str] = COUNTED) -> DataFrame:
    """Per group (``fecha``, ``periodico`` by default): rows, and a sketch of each counted column; NULL is no value.

    Sketches are filled where the rows are read, so a group that holds most rows
    reaches the shuffle as one sketch per task.
    """
    sketches = (F.hll_sketch_agg(F.col(name), F.lit(PRECISION)).alias(f"{name}_sketch") for name in counted)
    return news.groupBy(*(group or ("fecha", "periodico"))).agg(F.count("*").alias("total_records"), *sketches)


def merged_statistics(sketches: DataFrame, *group: str, counted: Mapping[str, str] = COUNTED) -> DataFrame:
    """Rows and estimated distinct counts per group, or over all sketches without one."""
    estimates = (
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(f"{name}_sketch"))), F.lit(0)).alias(made)
        for name, made in counted.items()
    )
    return sketches.groupBy(*group).agg(F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"), *estimates)


def between(sketches: DataFrame, first: Column, last: Column) -> DataFrame:
    """The sketches of a range of days, both included; with days as folders only those are read."""
    return sketches.where(F.col("fecha").between(first, last))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Keep sketches by day; the days that are there are replaced, so a day that is loaded again counts once."""
    (
        sketches.hint("rebalance", "fecha")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fecha")
        .parquet(path)
    )


def near(estimate: Column, exact: Column, errors: float = 4.0) -> Column:
    """The estimate is within so many standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.greatest(exact * errors * STANDARD_ERROR, F.lit(1.0))
