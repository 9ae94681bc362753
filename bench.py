"""Headline timings: prints one JSON line.

The given tables are single files with one row group, which one task would read. They are
written once into `BENCH_FILES` files each (default 16) before anything is timed, as a
table on a cluster would be; all rows and columns stay as they are. Each query runs once untimed on the same tables, so that class loading and code
generation do not count, and then `BENCH_RUNS` times (default 2); the best run
counts. Results are fully computed and discarded, not counted or cut short.
"""

import json
import os
import time
from pathlib import Path

from siftloom.catalog.queries import QUERIES
from siftloom.session import local_session, scratch_path

HEADLINE = (
    "clean_documents", "quality_filtered", "accepted_samples", "reject_report",
    "validation_errors", "token_counts", "detect_language", "adapter_apps", "sft_pairs",
    "minhash_signature", "near_dedup", "dedup_counts", "corpus_stats", "stats_by_dimension",
    "train_val_split", "shuffle_order", "roundtrip_jsonl", "deduplicated_corpus",
)


def spread(spark, sf_dir, files):
    """The tables below ``sf_dir``, each in so many files."""
    out = scratch_path(spark, "bench")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(files).write.parquet(f"{out}/{path.name}")
    return out


def run_once(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, spark__ui__showConsoleProgress="false")
    files = int(os.environ.get("BENCH_FILES", "16"))
    tables = spread(spark, sf_dir, files)
    seconds = {}
    for name in HEADLINE:
        run_once(spark, name, tables)
        seconds[name] = round(min(run_once(spark, name, tables) for _ in range(runs)), 3)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "total time of the headline queries, best of runs after one warm-up each",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1], "documents": documents, "files_per_table": files,
        "documents_per_sec": {n: round(documents / s) for n, s in seconds.items()
                              if n not in ("sft_pairs",)},
    }))


if __name__ == "__main__":
    main()
