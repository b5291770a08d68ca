import os
import uuid

from followgraph.operators import graph
from followgraph.operators.lineage import checkpoint_dir
from followgraph.streaming.edges import edge_stream


def test_follower_counts_over_stream(spark, scratch_dir):
    src = os.path.join(scratch_dir, uuid.uuid4().hex)
    os.makedirs(src)
    with open(os.path.join(src, "a.tsv"), "w") as f:
        f.write("0\t2\n1\t0\nbad\tline\n1\t2\n")
    with open(os.path.join(src, "b.tsv"), "w") as f:
        f.write("1\t3\n2\t3\n")
    name = f"fc_{uuid.uuid4().hex[:8]}"
    q = (
        graph.follower_counts(edge_stream(spark, src, max_files_per_trigger=1))
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", f"{checkpoint_dir(spark)}/stream-{name}")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = {r["userId"]: r["followerCount"] for r in spark.table(name).collect()}
    assert got == {0: 1, 1: 0, 2: 2, 3: 2}
