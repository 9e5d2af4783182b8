"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once on the smallest tables to warm the JVM up, then once timed, with all rows
computed and none sent to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textgauge.plans import catalog  # noqa: E402
from textgauge.session import build_session  # noqa: E402

HEADLINE = [
    "a1_corpus_bleu_first_run", "a2_corpus_bleu_recomputed", "a3_rouge_pairs", "a3_rouge_stemmed",
    "a4_item_means", "a5_meteor_exact", "a5_meteor_stemmed", "a7_slot_means",
    "evaluation_first_run", "evaluation_recomputed", "j2_pairs", "j9_richer_but_lower",
    "p1_row_id", "p2_normalised", "p3_whitespace_tokens", "p4_rouge_stems", "s5_page_text",
    "c1_recursive_chunks", "c2_page_then_chunks", "c3_stride_chunks", "m1_model_batches",
    "m2_hashed_embedding", "k4_chunk_store", "j6_nearest_chunks", "o2_top_k",
    "m5_approximate_nearest", "u1_both_modes", "k1_run_items",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        begun = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    times = {}
    for name in HEADLINE:
        run(name, small if os.path.isdir(small) else sf_dir)
        times[name] = round(run(name, sf_dir), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
