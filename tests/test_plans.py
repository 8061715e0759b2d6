"""Physical plans: what is read, what is shuffled, where code runs."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from testbed.bindings import AS_OF, table
from testbed.queries import QUERIES
from watchlytics.operators import quality
from watchlytics.plans.models import PARTITIONS
from watchlytics.schemas import TABLES
from watchlytics.sources.staging_store import materialize

LAZY = [
    "stg_users", "stg_viewing_sessions", "user_viewing_stats", "dim_users", "dim_content", "fact_viewing_sessions",
    "content_performance_agg", "mart_content_performance", "mart_user_engagement", "mart_subscription_analytics",
    "popular_content", "daily_engagement", "top_content", "plan_share", "tv_show_sessions", "dq_unique",
    "dq_relationships", "clean_latest_per_id", "clean_delete_shared_load_ts", "derive_completion", "verify_counts",
]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", LAZY)
def test_no_product_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_staging_filter_reaches_the_scan(spark):
    text = plan(QUERIES["fact_viewing_sessions"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-06T00:00" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["user_subscription_stats"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(QUERIES["total_users"](spark, SF)))
    assert sorted(schemas) == ["c_nationkey:bigint", "n_nationkey:bigint"] or sorted(schemas) == ["c_nationkey:int", "n_nationkey:int"]


def test_keep_first_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["clean_latest_per_id"](spark, SF))
    assert text.count("WindowGroupLimit") >= 2  # once per task before the exchange, once after it


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_rated_content"](spark, SF))


def test_global_rank_uses_no_single_partition_window_over_rows(spark):
    """Windows over rows are partitioned by range bucket; the only one over everything sees one row per bucket."""
    df = QUERIES["mart_content_performance"](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [(i, line) for i, line in enumerate(optimized) if re.search(r"[+:\- ]Window \[", line)]
    assert len(windows) >= 2
    whole = [i for i, line in windows if not re.search(r"\], \[_bucket#\d+\], \[", line)]
    assert len(whole) < len(windows)
    for i in whole:
        below = next(line for line in optimized[i + 1 :] if "Project" not in line)
        assert "Aggregate [_bucket#" in below, below


def test_quality_report_reads_each_table_twice(spark):
    """All key checks and relationships come from one pass per table, all row rules from another."""
    tables = {name: table(spark, SF, name) for name in TABLES}
    text = quality.dq_report(tables, as_of=AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    # users read customer and nation; seven of the nine tables come from three files
    assert text.count("Relation [") <= 2 * (len(TABLES) + 1), text.count("Relation [")


def test_date_filter_on_the_stored_fact_opens_only_its_folders(spark, tmp_path):
    fact = QUERIES["fact_viewing_sessions"](spark, SF)
    name = materialize(fact, "core", "fact_by_day", str(tmp_path / "fact"), PARTITIONS["fact_viewing_sessions"])
    day = spark.table(name).agg(F.max("date_key")).first()[0]
    one = spark.table(name).where(F.col("date_key") == F.lit(day))
    assert f"date_key#" in re.search(r"PartitionFilters: \[.*?\]\n", plan(one))[0]
    assert len(one.inputFiles()) < len(spark.table(name).inputFiles())
    assert one.count() == fact.where(F.col("date_key") == F.lit(day)).count() > 0


def test_popular_content_aggregates_children_before_the_join(spark):
    df = QUERIES["popular_content"](spark, SF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(optimized) if "Join LeftOuter" in line]
    aggregates = [i for i, line in enumerate(optimized) if "Aggregate [content_id" in line]
    assert joins and aggregates and min(joins) < min(a for a in aggregates)
