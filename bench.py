"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected), cold (fresh checkpoint tables each
run, nothing cached), and the median of ``BENCH_REPEATS`` runs is
reported.  Each query first runs once untimed (``BENCH_WARMUP=1``), so
JIT start-up of the JVM is not charged to whichever query comes first.

``pagerank_x8`` ranks 8 copies of the graph with shifted ids, once and
without warm-up, so that data, not jobs, takes the time.  Shuffle partitions are
three times the CPUs: plans must not depend on the two being equal.
``details`` has each query's shuffled MB (from Spark's event log in the
scratch folder) and the seconds of one PageRank round, from runs of 10 and
of 1 rounds.  ``BENCH_SCRATCH`` names the scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def session(cpus: int, scratch: str):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("followgraph-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(3 * cpus))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{scratch}/events")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def copies(edges, n: int):
    """``n`` copies of the graph side by side, ids shifted by the copy."""
    from pyspark.sql import functions as F

    shift = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    wide = edges.select("*", shift.alias("copy"))
    return wide.select(*[(F.col("copy") * F.lit(1 << 40) + F.col(c)).alias(c) for c in ("source", "destination")])


def shuffled_mb(scratch: str, spans: dict[str, tuple[float, float]]) -> dict[str, float]:
    """MB written to shuffles by the tasks that started in each span of time."""
    out = dict.fromkeys(spans, 0.0)
    for path in glob.glob(f"{scratch}/events/*"):
        with open(path) as lines:
            for line in lines:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                event = json.loads(line)
                written = event.get("Task Metrics", {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                for name, (a, b) in spans.items():
                    if a <= event["Task Info"]["Launch Time"] / 1000 <= b:
                        out[name] += written / 1e6
    return {k: round(v, 1) for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    scratch = tempfile.mkdtemp(prefix="fg-bench-", dir=os.environ.get("BENCH_SCRATCH"))
    os.makedirs(f"{scratch}/events")
    spark = session(cpus, scratch)
    spark.sparkContext.setLogLevel("ERROR")

    from followgraph.operators import graph, lineage
    from followgraph.operators import pagerank as pr
    from followgraph.operators import recommend as rc
    from followgraph.sources.tables import edges_from, topics_from

    plans = {
        "pagerank": lambda: pr.pagerank(edges_from(spark, sf_dir), 10, 0.85),
        "recommendations": lambda: rc.recommendations(
            edges_from(spark, sf_dir), topics_from(spark, sf_dir), 10
        ),
        "top_followed": lambda: graph.top_followed(edges_from(spark, sf_dir), 100),
        "pagerank_x8": lambda rounds=10: pr.pagerank(copies(edges_from(spark, sf_dir), 8), rounds, 0.85),
    }
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    warmup = int(os.environ.get("BENCH_WARMUP", "1"))
    times: dict[str, float] = {}
    rounds: dict[str, float] = {}
    spans: dict[str, tuple[float, float]] = {}

    def timed(build) -> float:
        t0 = time.perf_counter()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        lineage.release(df)
        return took

    for name, build in plans.items():
        if only and name not in only:
            continue
        big = name.startswith("pagerank_x")
        for _ in range(0 if big else warmup):
            timed(build)
        runs = [timed(build) for _ in range((1 if big else repeats) - 1)]
        begin = time.time()
        runs.append(timed(build))
        spans[name] = begin, time.time()
        times[name] = round(statistics.median(runs), 3)
        if big:
            rounds[name] = round((times[name] - timed(lambda b=build: b(1))) / 9, 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "median_wall_seconds_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeats": repeats,
                "warmup": warmup,
                "details": {"shuffled_mb": shuffled_mb(scratch, spans), "seconds_per_round": rounds},
            }
        )
    )


if __name__ == "__main__":
    main()
