"""Timings of the headline queries.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query runs once to warm
up and then ``$BENCH_RUNS`` times (default 3); the median counts.  Results are
consumed in full by a sink that keeps nothing.

The tables are one file of one row group each, which only one task can read.
Before the timing they are copied into as many files as there are cores, as a
table of any size would lie; rows and values are the same.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

HEADLINE_QUERIES = (
    "news_summary",
    "mysql_transform",
    "dedupe_title_date",
    "insert_if_absent",
    "processing_stats",
    "category_trend",
    "recent_news",
    "clean_text",
    "token_counts",
    "tfidf_terms",
    "article_headlines",
    "dedupe_by_link",
    "headline_dispatch",
    "node_text",
    "partitions_missing",
    "missing_outputs",
    "csv_partition_scan",
    "partition_write_roundtrip",
    "stream_ingest",
    "incremental_load",
    "hashing_tfidf",
    "ml_predictions",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE_QUERIES

    from rotativa.queries import QUERIES
    from rotativa.session import build_session, new_folder

    spark = build_session(
        "rotativa-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    tables = new_folder(spark, "bench-tables")
    for file in sorted(Path(folder).glob("*.parquet")):
        spark.read.parquet(str(file)).repartition(int(cpus)).write.parquet(f"{tables}/{file.name}")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total time of the headline queries, median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
