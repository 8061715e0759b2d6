"""Queries with joins against their SQL, once with broadcasts and once with shuffles only."""

import pytest
from conftest import SF

from testbed.check import compare, duckdb_tables
from testbed.oracle import oracles

JOINING = [
    "dim_users",
    "dim_content",
    "content_performance_agg",
    "mart_user_engagement",
    "mart_subscription_analytics",
    "popular_content",
    "top_content",
    "tv_show_sessions",
    "derive_completion",
    "clean_delete_shared_load_ts",
]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("name", JOINING)
def test_the_way_of_a_join_does_not_change_results(spark, name, threshold):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, threshold)
    try:
        assert compare(spark, duckdb_tables(SF), SF, name, oracles()[name]) == ""
    finally:
        for key in keys:
            spark.conf.unset(key)
