import os
import uuid

import pytest

from followgraph.jobs import network_stats, pagerank, recommend
from tests.conftest import GOLDEN_EDGES, GOLDEN_TOPICS
from tests.test_pagerank import GOLDEN_RANKS

REF_EDGES = "".join(f"{a}\t{b}\n" for a, b in GOLDEN_EDGES)
REF_TOPICS = "userId  games   movies  music\n" + "".join("\t".join(map(str, r)) + "\n" for r in GOLDEN_TOPICS)


@pytest.fixture()
def inputs(scratch_dir):
    base = os.path.join(scratch_dir, uuid.uuid4().hex)
    os.makedirs(base)
    for name, body in (("graph", REF_EDGES), ("topics", REF_TOPICS)):
        with open(os.path.join(base, name), "w") as f:
            f.write(body)
    return base


def test_usage_exits_1():
    for job, argv in ((network_stats, ["a"]), (pagerank, []), (recommend, ["a", "b"])):
        with pytest.raises(SystemExit) as e:
            job.run(None, argv)
        assert e.value.code == 1


def test_main_exit_codes(spark, inputs, monkeypatch):
    """A job that fails ends with 1, one without arguments too."""
    for job, argv in ((pagerank, [os.path.join(inputs, "none"), inputs]), (recommend, [os.path.join(inputs, "none")] * 3), (pagerank, []), (recommend, [])):
        monkeypatch.setattr("sys.argv", ["job", *argv])
        with pytest.raises(SystemExit) as e:
            job.main()
        assert e.value.code == 1
    monkeypatch.setattr("sys.argv", ["job", os.path.join(inputs, "graph"), os.path.join(inputs, "main-out"), "1", "2"])
    assert pagerank.main() is None


def test_network_stats_job(spark, inputs):
    out = os.path.join(inputs, "out")
    network_stats.run(spark, [os.path.join(inputs, "graph"), out, "2"])
    stats = {r["metric"]: r["value"] for r in spark.read.parquet(f"{out}/graph-stats").collect()}
    assert stats == {"edge_count": 5, "vertex_count": 4}
    top = spark.read.parquet(f"{out}/top-2-users").orderBy("followerCount", ascending=False).collect()
    assert [(r["userId"], r["followerCount"]) for r in top] == [(2, 2), (3, 2)]


def test_pagerank_job(spark, inputs):
    out = os.path.join(inputs, "out")
    pagerank.run(spark, [os.path.join(inputs, "graph"), out, "10", "2"])
    ranks = {r["userId"]: r["rank"] for r in spark.read.parquet(f"{out}/pagerank-results").collect()}
    assert ranks == {u: pytest.approx(r, abs=1e-6) for u, r in GOLDEN_RANKS.items()}
    top = spark.read.parquet(f"{out}/top-2-ranked-users").collect()
    assert sorted(r["userId"] for r in top) == [2, 3]


def test_recommend_job(spark, inputs):
    out = os.path.join(inputs, "out")
    recommend.run(spark, [os.path.join(inputs, "graph"), os.path.join(inputs, "topics"), out])
    df = spark.read.parquet(f"{out}/recommendations")
    assert df.columns == ["userId", "postFrequency", "topic", "recommendedUserId"]
    got = {r["userId"]: (r["recommendedUserId"], r["topic"]) for r in df.collect()}
    assert got == {0: (0, "movies"), 1: (1, "games"), 2: (1, "games"), 3: (0, "music")}
