"""Print the physical plans of the main stages (for PLANS.md).

    python -m followgraph.plans.show /root/testdata/sf0.01 > PLANS.md

Broadcast joins are switched off while planning, so the plans shown are
the ones a large cluster gets once the tables outgrow the broadcast
threshold.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    cleaned = []
    for line in text.splitlines():
        # drop machine-specific file locations
        if "Location: " in line:
            head, _, tail = line.partition("Location: ")
            line = head + tail.partition(", ")[2]
        cleaned.append(line)
    return "\n".join(cleaned).strip()


def main(sf_dir: str) -> None:
    from followgraph.operators import graph, lineage
    from followgraph.operators import pagerank as pr
    from followgraph.operators import recommend as rc
    from followgraph.sources.tables import edges_from, topics_from

    scratch = tempfile.mkdtemp(prefix="fg-plans-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    edges, topics = edges_from(spark, sf_dir), topics_from(spark, sf_dir)
    sections = [
        ("top_followed (G5, G6)", graph.top_followed(edges, 100)),
        ("graph_stats (G1-G4)", graph.graph_stats(edges)),
        ("adjacency (G7)", graph.adjacency(edges)),
    ]
    g = pr.prepare(edges)
    ranks, _ = pr.run(g, 1)
    sections.append(("PageRank round (P2-P5), ranks read from the previous round's bucketed table", pr.step(ranks, g, 0.1, 0.85)))
    ed = rc.edge_degrees(edges)
    state = rc.numbered(rc.initial_state(edges, topics, users=ed.degrees.select("userId")).where("interested"))
    current, _, _ = lineage.write_table(
        state.select("*", F.lit(True).alias("improved")), "state", ["userId", "topic"], 8
    )
    tl = rc.prepare(ed, current)
    sections.append(
        (
            "Recommendation round (R3-R5), frontier and state read from the bucketed state table",
            rc.update(current.drop("improved", "max_user"), rc.numbered_offers(current.where("improved"), tl, 1), 1, 8),
        )
    )
    sections.append(("Final pick (R7-R9)", rc.pick(current.drop("number"))))
    print("# Physical plans\n")
    print("Generated by `python -m followgraph.plans.show " + sf_dir + "` with broadcast joins off")
    print("(the plans of a cluster whose tables exceed the broadcast threshold).\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{_plan(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
