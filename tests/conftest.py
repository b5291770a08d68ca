import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from followgraph.operators.lineage import ensure_checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="fg-tests-")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("followgraph-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="fg-out-")


def edges_df(spark, pairs):
    from followgraph.sources.schemas import EDGE_SCHEMA

    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], EDGE_SCHEMA)


def topics_df(spark, rows):
    from followgraph.sources.schemas import TOPIC_SCHEMA

    return spark.createDataFrame(
        [(int(r[0]),) + tuple(float(x) for x in r[1:]) for r in rows], TOPIC_SCHEMA
    )


# The small graph and topics whose results are known.
GOLDEN_EDGES = [(0, 2), (1, 0), (1, 2), (1, 3), (2, 3)]
GOLDEN_TOPICS = [(0, 0.2, 5.6, 4.2), (1, 5.3, 3.7, 1.0), (2, 4.5, 2.4, 3.1), (3, 2.5, 3.5, 4.0)]
