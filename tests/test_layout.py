import pytest

from followgraph.operators import lineage, skew
from tests.conftest import GOLDEN_EDGES, GOLDEN_TOPICS, edges_df, topics_df


def test_hot_threshold_bounds_key_count():
    assert skew.hot_threshold(0) == skew.HOT_MIN_ROWS
    assert skew.hot_threshold(10**6) == skew.HOT_MIN_ROWS
    big = 6 * 10**12
    t = skew.hot_threshold(big)
    assert t == -(-big // skew.HOT_MAX_KEYS)
    # keys with more than t rows: at most total / t <= HOT_MAX_KEYS of them
    assert big // t <= skew.HOT_MAX_KEYS


def test_hot_keys_and_salts(spark):
    counts = spark.createDataFrame([(1, 100), (2, 10), (3, 31)], "k long, n long")
    hot = {r["hot_key"]: (r["hot_rows"], r["n_salt"]) for r in skew.hot_keys(counts, "k", "n", 30).collect()}
    assert hot == {1: (100, 4), 3: (31, 2)}
    assert skew.collect_hot(counts, "k", "n", 1000, total=141) is None


def test_salted_join_is_exact(spark):
    from pyspark.sql import functions as F

    big = spark.createDataFrame([(1, d) for d in range(50)] + [(2, 7)], "k long, d long")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(counts, "k", "n", 10)
    joined = skew.add_salt(big, "k", "d", hot).join(skew.replicate(small, "k", hot), ["k", "salt"])
    assert joined.count() == 51
    assert joined.where("k = 1").select("salt").distinct().count() > 1
    assert sorted(r["d"] for r in joined.where("k = 1").collect()) == list(range(50))


def test_bucket_count(spark):
    """Buckets follow the rows, whatever the session's shuffle partitions."""
    par = spark.sparkContext.defaultParallelism
    assert lineage.bucket_count(spark, 10) == par
    assert lineage.bucket_count(spark, 1000 * lineage.ROWS_PER_BUCKET) == 1000
    assert lineage.bucket_count(spark, 10**15) == lineage.MOST_BUCKETS


def test_one_exchange_per_round(spark):
    """With shuffle partitions other than the buckets, a PageRank round still
    shuffles its contributions only, and reads links and ranks in place."""
    from followgraph.operators import pagerank as pr

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = pr.prepare(edges_df(spark, [(i, (7 * i + j) % 90) for i in range(60) for j in range(3)]), buckets=6)
        ranks, _ = pr.run(g, 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        with lineage.shuffle_width(spark, g.buckets):
            plan = pr.step(ranks, g, 0.1, 0.85).repartition(g.buckets, "userId")
            lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
        exchanges = [x for x in lines if "Exchange" in x]
        assert len(exchanges) == 1 and "hashpartitioning(userId" in exchanges[0], exchanges
        assert sum("Bucketed: true" in x for x in lines) == 3, lines
        g.release()
        lineage.release(ranks)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_recommendation_round_hashes(spark):
    """No sort aggregation in a round."""
    from followgraph.operators import recommend as rc

    edges = edges_df(spark, [(i, (7 * i + j) % 30) for i in range(30) for j in range(3)])
    topics = topics_df(spark, [(i, i % 7, 4.0, 0.5) for i in range(30)])
    ed = rc.edge_degrees(edges)
    order, _ = lineage.materialize(rc.numbered(rc.initial_state(edges, topics)))
    tl = rc.prepare(ed, order)
    plan = rc.numbered_offers(order, tl)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    tl.release()
    ed.release()


def left_over(spark):
    """Tables and data files of the scratch database."""
    name = lineage.scratch_database(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{lineage.checkpoint_dir(spark)}/{name}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {name}").collect()]
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return found


def test_nothing_is_left(spark, monkeypatch):
    from followgraph.operators import pagerank as pr
    from followgraph.operators import recommend as rc

    lineage.clear(spark)
    edges = edges_df(spark, GOLDEN_EDGES)
    for rounds in (0, 3):
        ranks = pr.pagerank(edges, rounds)
        assert ranks.count() == 4
        lineage.release(ranks)
        assert left_over(spark) == []
    recs = rc.recommendations(edges, topics_df(spark, GOLDEN_TOPICS), 3)
    assert recs.count() == 4
    lineage.release(recs)
    assert left_over(spark) == []
    monkeypatch.setattr(pr, "RANK_SUM_FAIL", -1.0)
    with pytest.raises(pr.RankSumError):
        pr.pagerank(edges, 2)
    assert left_over(spark) == []


def test_too_many_hot_keys_are_refused(spark):
    counts = spark.createDataFrame([(i, 100) for i in range(9)], "k long, n long")
    with pytest.raises(ValueError, match="hot keys"):
        skew.collect_hot(counts, "k", "n", 10, max_keys=5)


def test_checkpoint_dir_required():
    class NoDir:
        class sparkContext:  # noqa: N801 - mimics the session attribute
            @staticmethod
            def getCheckpointDir():
                return None

            @staticmethod
            def getConf():
                return {}

    with pytest.raises(RuntimeError):
        lineage.checkpoint_dir(NoDir())
