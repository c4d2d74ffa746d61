"""Headline queries, warm, on one machine; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of task slots.
Each query runs once to warm up, then BENCH_RUNS times; the median counts.
Results are computed in full (every column of every row) and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from textloom.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "corpus_stats",
    "clean_records",
    "clean_dialogues",
    "clean_text_full",
    "stream_clean",
    "src_min_length",
    "src_nested_explode",
    "src_run_concat",
    "src_group_concat",
    "src_hash_dedup",
    "src_lang_cap",
    "src_stop_marker",
    "mix_sample",
    "chunk_text",
    "chunk_ids",
    "lang_stats",
    "global_shuffle",
    "sink_roundtrip",
    "lang_detect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
