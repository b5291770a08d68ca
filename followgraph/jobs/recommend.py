"""One recommended user per user, by topic.

    spark-submit followgraph/jobs/recommend.py <graph> <topics> <output> [iterations=10]

Writes ``<output>/recommendations`` (userId, postFrequency, topic,
recommendedUserId).  The topic file may or may not start with a header.
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
from followgraph.operators import recommend as rc
from followgraph.sources import sinks, text

USAGE = "usage: recommend.py <graph> <topics> <output> [iterations=10]"


def run(spark: SparkSession, argv: list[str]) -> None:
    usage(USAGE, argv, 3)
    graph_path, topics_path, out = argv[0], argv[1], argv[2].rstrip("/")
    iterations = int(argv[3]) if len(argv) > 3 else 10
    use_checkpoints(spark, out)
    t0 = time.time()
    recs = rc.recommendations(
        text.read_edges(spark, graph_path), text.read_topics(spark, topics_path), iterations
    )
    sinks.write_parquet(recs, f"{out}/recommendations")
    lineage.release(recs)
    print(f"recommendations done in {time.time() - t0:.1f} s")


def main() -> None:
    try:
        run(session("recommendations"), sys.argv[1:])
    except SystemExit:
        raise
    except Exception as exc:  # noqa: BLE001
        print(f"recommendations failed: {exc}", file=sys.stderr)
        raise SystemExit(1) from exc


if __name__ == "__main__":
    main()
