"""Headline timings: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (all rows computed,
nothing collected); the reported time is the best of ``BENCH_REPEAT`` (2)
runs after an untimed warm-up.  Configurations follow the original job's recorded
runs: General with LAMBDA=20, ITER=3 (batch) and both modes with
LAMBDA=20, ITER=10 (demo).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from peerrank.operators.general import general_graph, general_rank  # noqa: E402
from peerrank.operators.links import general_links  # noqa: E402
from peerrank.operators.product import product_rank  # noqa: E402
from peerrank.operators.report import leaderboard  # noqa: E402
from peerrank.session import cut_lineage, local_session  # noqa: E402
from peerrank.sources.reviews import reviews_from_tables  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_PARTITIONS", str(cpus)))
    spark = local_session(cpus, shuffle_partitions=parts, app="peerrank-bench")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")

    def reviews():
        return reviews_from_tables(spark, sf_dir)

    timings: dict[str, float] = {}

    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    def timed(name, fn):
        # best of `repeat` runs: single runs on a shared machine vary by ~30%
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)

    # Untimed warm-up over the same code paths (JIT, parquet footers): the
    # first run of a plan shape in a fresh JVM is 1.5-2x slower than steady state.
    run(reviews())
    general_rank(reviews(), 20, 1).count()
    product_rank(reviews(), 20, 1).count()
    leaderboard(product_rank(reviews(), 20, 1, trace=True)).count()

    timed("reviews_load", lambda: run(reviews()))
    timed("general_links", lambda: general_graph(reviews()).links.count())
    timed("general_rank_it3", lambda: run(general_rank(reviews(), 20, 3)))
    timed("general_rank_it10", lambda: run(general_rank(reviews(), 20, 10)))
    timed("product_rank_it3", lambda: run(product_rank(reviews(), 20, 3)))
    timed("product_rank_it10", lambda: run(product_rank(reviews(), 20, 10)))

    def board():
        trace = cut_lineage(product_rank(reviews(), 20, 10, trace=True))
        run(leaderboard(trace))

    timed("product_trace_leaderboard_it10", board)
    total = round(sum(timings.values()), 3)
    # the skew paths, at thresholds far below the defaults; reported apart from the total
    headline, timings = timings, {}
    timed("general_links_blocks", lambda: run(general_links(reviews(), block_members=8)))
    timed("product_rank_hot_it3", lambda: run(product_rank(reviews(), 20, 3, hot_rows=40)))

    print(json.dumps({
        "metric": "total_query_time",
        "value": total,
        "unit": "sec",
        "queries": headline,
        "skew_queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "partitions": parts,
        "stat": f"min of {repeat} runs after warm-up",
    }))


if __name__ == "__main__":
    main()
