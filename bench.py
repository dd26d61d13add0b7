"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each query is run to a
full result in the JVM ("noop" sink). ``python bench.py name ...`` times other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tests.session import local_session
from textmill.queries import QUERIES

HEADLINE = [
    "clean_text", "dedupe_first", "build_report", "byte_budget", "json_lines", "multi_source", "mix_sources",
    "convert_dict", "corpus_build", "corpus_build_mixed", "pretrain_layout", "sft_layout", "pretoken_freq",
    "pair_count", "bpe_merges", "encode_text", "encode_chat", "decode_roundtrip", "epoch_shards", "batches",
    "jsonl_roundtrip", "pretrain_feed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start-up is not timed
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
