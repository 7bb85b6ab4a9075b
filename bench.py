"""Time the headline queries: one warm-up run, then the median of the next runs. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_user_day",
    "f01_group_agg",
    "f02_order_statistics",
    "f04_group_stats",
    "f06_side_table",
    "f07_describe",
    "f17_corr_spearman",
    "f27_deep_features",
    "f29_raster",
    "e05_qcut",
    "e12_feature_index_pooled",
    "e14_encode_rows",
    "j01_rank_scaled",
    "k03_stratified_folds",
    "l05_auc",
    "l11_gini_norm",
    "m04_blend_rank_mean",
    "o09_vocab",
    "o11_encode_skip",
    "o19_tfidf",
    "o20_entropy_weights",
    "p03_bleu",
    "p04_rouge_l",
    "p05_cider",
    "q01_ks_2samp",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    from quarrymill.catalog import QUERIES
    from quarrymill.plans.session import build_session

    spark = build_session("bench", cores, int(cores) if cores.isdigit() else 8)
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    print(json.dumps({
        "metric": "total warm time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
