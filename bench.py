"""Benchmark: run the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma-separated keys, default the headline set).
Each query is executed in full with the ``noop`` sink (no collect to the driver),
after a warm-up of the JVM and the Python workers on the smallest data folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rankshelf.functions.columns import split_key  # noqa: E402
from rankshelf.operators.collaborative import collaborative  # noqa: E402
from rankshelf.operators.content import cosine_knn  # noqa: E402
from rankshelf.operators.readlists import histories_of  # noqa: E402
from rankshelf.plans.catalog import QUERIES  # noqa: E402
from rankshelf.plans.evaluate import test_users  # noqa: E402
from rankshelf.session import local_session  # noqa: E402
from rankshelf.sources.tables import Tables  # noqa: E402

HEADLINE = [
    "q08_popularity_rank",
    "q09_top_unread",
    "q12_cf_topn",
    "q14_cosine_knn",
    "q15_content_topn",
    "q19_hybrid",
    "q22_eval_warm",
    "q23_eval_cold",
    "q28_embed_job",
    "q39_tfidf",
]


def probe_cf_top100(spark, sf_dir):
    t = Tables(spark, sf_dir)
    users = test_users(t.reads)
    return collaborative(histories_of(t.reads.join(users, "user_id", "left_semi")), t.reads, 100)


def probe_knn_200x30(spark, sf_dir):
    """Same work as the cosine k-NN sizing probe: 200 query vectors against all vectors, top 30."""
    emb = Tables(spark, sf_dir).embeddings
    queries = emb.orderBy(split_key("item_id")).limit(200).select(
        F.col("item_id").alias("query_id"), "embedding", F.lit(30).alias("k")
    )
    return cosine_knn(queries, emb)


PROBES = {"probe_cf_top100": probe_cf_top100, "probe_knn_200x30": probe_knn_200x30}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + list(PROBES))).split(",") if k]
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "64")), app="rankshelf-bench")
    # warm-up: JVM, parquet footers, and one Python worker per core (workers are reused)
    QUERIES["q01_read_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, int(cpus)).mapInPandas(lambda it: (b for b in it), "id long").write.format("noop").mode(
        "overwrite"
    ).save()
    # JIT warm-up of the common operators on the smallest folder (different data: nothing is reused)
    tiny = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(tiny):
        QUERIES["q19_hybrid"](spark, tiny).write.format("noop").mode("overwrite").save()
    times = {}
    for key in keys:
        t0 = time.perf_counter()
        (QUERIES.get(key) or PROBES[key])(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
