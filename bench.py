"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Each query runs twice to warm the JVM and once on the clock, and its result goes
to Spark's noop sink, so that every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crowdtide.plans.queries import QUERIES  # noqa: E402
from crowdtide.session import build_session  # noqa: E402

HEADLINE = [
    "signals_flagship", "signals_event_windows", "signals_gap_filled", "signals_anchored_7min",
    "clean_documents", "dedupe_documents", "dedupe_second_run", "lexical_score", "tfidf_corpus",
    "tfidf_chunk", "hashed_tfidf", "embed_documents", "embedding_contrast", "standardize",
    "mentions_hashtags", "page_records", "label_counts", "roundrobin_cap",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
