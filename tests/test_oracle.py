"""Every registered query against its DuckDB oracle (the driver's check,
on the smallest tables)."""

import os

import pytest

from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_duckdb(spark):
    report = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in report.items() if not v["ok"]}
    assert not bad, bad
    assert report["pagerank"]["rows"][0] == 275
    assert report["parquet_roundtrip"]["rows"][0] == 6000


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["userId", "rank"] and len(rows) == 100
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"pagerank", "recommendations", "job_pagerank"} <= set(entry.oracle_sql())
