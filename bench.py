"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built from scratch and executed in full with the ``noop``
sink (every row is produced, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairloom.plans.catalog import QUERIES  # noqa: E402
from pairloom.session import build_session  # noqa: E402

HEADLINE = [
    "token_counts",
    "vocab_build",
    "sentence_index",
    "token_ids",
    "nsp_pairs",
    "training_examples",
    "split_exact",
    "split_by_document",
    "epoch_batches",
    "batch_manifest",
    "examples_written",
    "total_loss",
    "epoch_metrics",
    "conv_training_examples",
]


def _throughput(spark, sf_dir: str, times: dict) -> dict:
    """Rows/s and tokens/s of the timed queries (sizes counted untimed)."""
    from pyspark.sql import functions as F

    from pairloom.functions.text import split_words
    from pairloom.operators.corpus import clean_lines
    from pairloom.sources.corpus import documents_corpus, table

    lines = clean_lines(documents_corpus(table(spark, sf_dir, "documents")))
    sizes = lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.size(split_words("text"))).alias("tokens")).first()
    tot = QUERIES["corpus_totals"](spark, sf_dir).first()
    out = {}

    def rate(name, n, unit):
        if name in times and times[name] > 0:
            out[f"{name}_{unit}_per_sec"] = round(n / times[name], 1)

    rate("token_counts", sizes["tokens"], "tokens")
    rate("token_ids", tot["n_sentences"], "sentences")
    rate("nsp_pairs", tot["n_examples"], "pairs")
    rate("training_examples", tot["n_examples"], "examples")
    rate("batch_manifest", tot["n_train"] * 20, "example_epochs")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app_name="pairloom-bench",
        shuffle_partitions=max(8, 2 * cpus),
        # spark.checkpoint.dir comes from the session defaults; only when it is
        # unset does build_session pick a local folder (local mode only)
        extra_conf={"spark.driver.memory": "16g"},
    )
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    throughput = _throughput(spark, sf_dir, times)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "throughput": throughput,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
