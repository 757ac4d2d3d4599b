"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tastegraph.catalog.queries import QUERIES
from tastegraph.session import local_session

HEADLINE = [
    "ratings_dedup",
    "holdout_train",
    "mean_centered",
    "pearson_users",
    "pearson_items",
    "topk_neighbors",
    "user_knn",
    "user_knn_topk",
    "user_knn_candidates",
    "item_knn",
    "user_knn_rmse",
    "minhash_signature_rows",
    "jaccard_lsh_join",
    "jaccard_exact",
    "cosine_sets",
    "cosine_lsh_sets",
    "cosine_vectors",
    "iterative_cf",
    "als_rescaled",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, memory="16g")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the workers
    spent = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
        print(name, spent[name], file=sys.stderr, flush=True)
    total = round(sum(spent.values()), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": spent, "sf": os.path.basename(sf_dir)}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
