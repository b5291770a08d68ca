"""PageRank of every user and the top ranked.

    spark-submit followgraph/jobs/pagerank.py <input> <output> [iterations=10] [topN=100]

Writes ``<output>/pagerank-results`` (userId, rank; by rank descending)
and ``<output>/top-<N>-ranked-users``.  Damping is fixed at 0.85.
"""

from __future__ import annotations

import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import time

from pyspark.sql import SparkSession

from followgraph.jobs import session, usage, use_checkpoints
from followgraph.operators import lineage
from followgraph.operators import pagerank as pr
from followgraph.sources import sinks, text

USAGE = "usage: pagerank.py <input> <output> [iterations=10] [topN=100]"
DAMPING = 0.85


def run(spark: SparkSession, argv: list[str]) -> None:
    usage(USAGE, argv, 2)
    src, out = argv[0], argv[1].rstrip("/")
    iterations = int(argv[2]) if len(argv) > 2 else 10
    top_n = int(argv[3]) if len(argv) > 3 else 100
    use_checkpoints(spark, out)
    t0 = time.time()
    g = pr.prepare(text.read_edges(spark, src))
    try:
        print(f"users: {g.n}, edges: {g.n_edges}, dangling: {g.n_dangling}")
        ranks, sums = pr.run(g, iterations, DAMPING)
    finally:
        g.release()
    sinks.write_parquet(pr.ranked(ranks.select("userId", "rank")), f"{out}/pagerank-results")
    top, _ = lineage.materialize(pr.top_ranked(ranks.select("userId", "rank"), top_n))
    sinks.write_parquet_single(top, f"{out}/top-{top_n}-ranked-users")
    top.show(min(top_n, 20), truncate=False)
    lineage.release(ranks)
    print(f"rank sums per round: {sums}")
    print(f"PageRank done in {time.time() - t0:.1f} s")


def main() -> None:
    try:
        run(session("pagerank"), sys.argv[1:])
    except SystemExit:
        raise
    except Exception as exc:  # noqa: BLE001 - report and exit non-zero, as a batch job
        print(f"PageRank failed: {exc}", file=sys.stderr)
        raise SystemExit(1) from exc


if __name__ == "__main__":
    main()
