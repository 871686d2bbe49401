"""Every registered query against its SQL on the given tables."""

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection(data):
    return connect(data)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, data, connection, name):
    frame = queries()[name](spark, data)
    if name in SQL:
        assert difference(frame, connection, SQL[name]) is None
    else:
        assert frame.count() > 0


ALONG_JOINS = ["a1_workload_by_region", "a1_workload_bounded", "a2_regional_revenue", "a4_revenue_report",
               "a8_mechanism_breakdown", "a10_key_distribution", "j2_join_report", "j2_lossy_join_report",
               "k1_candidate_keys", "k6_predicted_partitions", "v1_other_groups", "z3_streamed_regions"]


@pytest.mark.parametrize("name", ALONG_JOINS)
def test_same_result_when_no_parent_fits_a_broadcast(spark, data, connection, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(queries()[name](spark, data), connection, SQL[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5
    assert [r.score_total for r in rows] == sorted((r.score_total for r in rows), reverse=True)
