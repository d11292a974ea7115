"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_rate_more_movies",
    "a2_rate_more_movies_recently",
    "a3_average_movies_score",
    "a5_genres_top_movies",
    "j1_movie_documents",
    "m5_item_similarity",
    "t4_score_events",
    "x2_search",
    "x3_more_like_this",
    "x4_fuzzy_genre",
    "u1_hybrid",
    "m3_user_recommendations",
    "t5_stream_recs",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from marquee.plans.registry import QUERIES, load_all
    from marquee.session import get_session
    load_all()
    spark = get_session(f"local[{cpus}]", app="marquee-bench", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # warm-up (JVM, Python workers): not timed
    QUERIES["a1_rate_more_movies"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()      # so that no query reads what another left
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
