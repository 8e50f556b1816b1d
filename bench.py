"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local cores. Every query runs once over its whole tables
and all its result rows are produced (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import re
import time

from quillspark.plans.catalog import QUERIES
from quillspark.session import local_session

HEADLINE = ["clean_page", "clean_a", "clean_b", "rare_words", "chunk_table", "text_stats", "word_freq", "tfidf_books", "tfidf_reviews",
            "embed_hashed", "vec_topk_l2", "answer_questions", "naive_bayes", "knn_classify", "kmeans_step", "cluster_top_terms",
            "frequent_itemsets"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus)
    took = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 2)
        spark.catalog.clearCache()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 2), "unit": "sec", "queries": took,
                      "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
