"""Joins with lookups, and joining operators over rows of which one key holds a third."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from watchlytics.functions.derivations import derive_completion
from watchlytics.functions.joins import lookup_join
from watchlytics.operators import core, marts, reports

SCHEMA = "id int, k int, j string"


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    keys = [(7, "a")] * 100 + [(None, "a")] * 80 + [(None, None)] * 60
    keys += [(rng.randrange(40), rng.choice(["a", "b", None])) for _ in range(60)]
    return spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], SCHEMA)


@pytest.fixture(scope="module")
def lookup(spark):
    data = [(k, j, f"{k}{j}") for k in [*range(5, 30), None] for j in ("a", "b", None)]
    return spark.createDataFrame(data, "k int, j string, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_single_key(spark, skewed, lookup, how):
    per_k = lookup.where("j = 'a'").select("k", "v")
    got = lookup_join(skewed, per_k, ["k"], how=how)
    known = {r.k: r.v for r in per_k.collect() if r.k is not None}
    want = [(r.id, r.k, r.j, known.get(r.k)) for r in skewed.collect() if how == "left" or r.k in known]
    assert got.columns == ["id", "k", "j", "v"]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_null_safe_composite_key(spark, skewed, lookup, how):
    got = lookup_join(skewed, lookup, ["k", "j"], how=how, null_safe=True)
    known = {(r.k, r.j): r.v for r in lookup.collect()}
    want = [(r.id, r.k, r.j, known.get((r.k, r.j))) for r in skewed.collect() if how == "left" or (r.k, r.j) in known]
    assert rows(got) == sorted(want, key=repr)


def test_empty_sides(spark, skewed, lookup):
    per_k = lookup.where("j = 'a'").select("k", "v")
    assert lookup_join(skewed.limit(0), per_k, ["k"]).count() == 0
    assert lookup_join(skewed, per_k.limit(0), ["k"]).count() == 0
    assert lookup_join(skewed, per_k.limit(0), ["k"], how="left").count() == skewed.count()


def test_unknown_join_type(skewed, lookup):
    with pytest.raises(ValueError):
        lookup_join(skewed, lookup, ["k"], how="right")


# --- a third of all sessions belongs to one user and one title -------------------------------

N = 60_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Sessions, content, users and events on disk."""
    folder = str(tmp_path_factory.mktemp("hot"))
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)).cast("int"))
    ids = spark.range(N).repartition(8).withColumn("key", key)
    frames = {
        "sessions": ids.select(
            "id",
            F.col("key").alias("user_id"),
            F.col("key").alias("content_id"),
            F.timestamp_seconds(F.lit(1_705_000_000) + F.col("id") * 60).cast("timestamp_ntz").alias("session_start"),
            F.lit(60).alias("duration_seconds"),
            F.lit("12.50").cast("decimal(5,2)").alias("completion_rate"),
            F.lit(1).alias("buffering_count"),
            F.lit("web").alias("platform"),
            F.lit("HD").alias("quality"),
        ),
        "content": spark.range(500).select(F.col("id").cast("int"), F.lit("tv_show").alias("content_type"), F.lit(30).alias("duration_minutes")),
        "users": spark.range(500).select(
            F.col("id").cast("int").alias("user_id"), F.lit("FR").alias("country"), F.lit("18-24").alias("age_group"), F.lit("basic").alias("subscription_plan")
        ),
        "events": ids.select(
            F.col("key").alias("user_id"), F.lit("renewal").alias("event_type"), F.lit(None).cast("timestamp_ntz").alias("event_at"), F.col("id").cast("string").alias("previous_plan"), F.lit("b").alias("new_plan")
        ),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


OPERATORS = {
    "derive_completion": (lambda t: derive_completion(t["sessions"], t["content"]), N, "sessions"),
    "tv_show_sessions": (lambda t: reports.tv_show_sessions(t["sessions"], t["content"]), N, "sessions"),
    "subscription_event_count": (lambda t: marts.subscription_event_count(t["events"]), N, "events"),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_adaptive_execution_splits_the_hot_key(spark, hot, small_partitions, name):
    make, n, _ = OPERATORS[name]
    df = make(hot)
    assert len(df.collect()) == n
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in text


@pytest.mark.parametrize("name", ["derive_completion", "tv_show_sessions"])
def test_sessions_are_read_once(spark, hot, name):
    make, _, table = OPERATORS[name]
    text = make(hot)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in text.splitlines() if "Relation" in line]
    assert len(scans) == 2


def test_no_task_far_above_the_others(spark, hot, small_partitions, tmp_path):
    """Rows per file, one of which each task of the join writes: the hot key's third is dealt out."""
    derive_completion(hot["sessions"], hot["content"]).write.parquet(str(tmp_path / "out"))
    files = spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name()).count()
    sizes = sorted(r["count"] for r in files.collect())
    assert sum(sizes) == N
    assert sizes[-1] < N / 6, sizes


def test_engagement_shrinks_before_the_join(spark, hot):
    found = marts.daily_engagement_agg(hot["sessions"], hot["users"])
    text = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(text) if "Join Inner" in line)
    assert any("Aggregate" in line for line in text[join + 1 :])
    assert found.agg(F.sum("total_sessions")).first()[0] == N
    day = found.orderBy(F.desc("total_sessions")).first()
    assert day.daily_active_users == day.unique_content_viewed


AGGREGATES = {
    "content_viewing_stats": lambda s, c: core.content_viewing_stats(s.withColumnRenamed("id", "viewing_session_id")),
    "content_performance_agg": marts.content_performance_agg,
}


@pytest.fixture(scope="module")
def hot_title(spark, hot):
    """Sessions of which one title holds a third, by 5,000 users, some unknown."""
    user = F.when(F.col("id") % 11 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)).cast("int"))
    titles = spark.range(500).select(
        F.col("id").cast("int").alias("content_id"), F.lit("t").alias("title"), F.lit("movie").alias("content_type"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("genre", "string"), ("subgenre", "string"), ("release_year", "int"))),
        F.lit(30).alias("duration_minutes"), F.lit(True).alias("is_original"), F.lit(None).cast("decimal(3,1)").alias("imdb_rating"),
    )
    return hot["sessions"].withColumn("user_id", user), titles


@pytest.mark.parametrize("name", list(AGGREGATES))
def test_sessions_of_a_hot_title_are_scanned_once(hot_title, small_partitions, name):
    sessions, titles = hot_title
    found = AGGREGATES[name](sessions, titles)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Relation" in line for line in plan) == 1
    joined = sessions.groupBy("content_id").agg(F.count("*"), F.count_distinct("user_id"), F.sum("duration_seconds"))
    columns = ["content_id", "total_sessions", "unique_viewers", "total_watch_time_seconds"]
    assert rows(found, *columns) == rows(joined)
    assert max(r[1] for r in rows(found, *columns)) >= N / 3


def test_no_task_gets_a_hot_title_alone(hot_title, small_partitions):
    """Rows that meet per content and user are spread; what is left per content is one row per task."""
    sessions, _ = hot_title
    pairs = sessions.groupBy("content_id", "user_id").count()
    sizes = [len(part) for part in pairs.rdd.glom().collect()]
    assert sum(sizes) > 10_000 and max(sizes) < 2 * sum(sizes) / len(sizes)
