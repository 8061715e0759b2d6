"""Cleaning, staging, core models and marts on edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from frames import frame, session, title, user
from pyspark.sql import functions as F

from watchlytics.functions import derivations
from watchlytics.operators import cleaning, core, marts, reports, staging

T1, T2 = "2024-01-06 01:00:00", "2024-01-06 02:00:00"


@pytest.fixture(scope="module")
def shared_load_ts(spark):
    return frame(spark, "users", *(user(i, _loaded_at=t) for i, t in [(1, T1), (1, T2), (2, T1), (3, T2), (4, None)]))


def stamped(df):
    return [(i, str(t) if t else None) for i, t in rows(df, "id", "_loaded_at")]


def test_literal_cleaning_deletes_by_load_time(shared_load_ts):
    kept = cleaning.clean_delete_shared_load_ts(shared_load_ts, "2024-01-06")
    assert stamped(kept) == [(1, T2), (3, T2), (4, None)]


def test_literal_cleaning_of_another_day_keeps_all(shared_load_ts):
    assert cleaning.clean_delete_shared_load_ts(shared_load_ts, "2024-01-07").count() == 5


def test_literal_cleaning_of_equal_copies(spark):
    df = frame(spark, "users", user(1, _loaded_at=T1), user(1, _loaded_at=T1), user(2, _loaded_at=T2))
    assert stamped(cleaning.clean_delete_shared_load_ts(df, "2024-01-06")) == [(2, T2)]


def test_latest_per_id(shared_load_ts):
    assert stamped(cleaning.clean_latest_per_id(shared_load_ts)) == [(1, T2), (2, T1), (3, T2), (4, None)]


def test_missing_load_time_counts_as_now(spark):
    df = frame(spark, "users", user(1, _loaded_at=T2, age_group="55+"), user(1, age_group="18-24"))
    assert rows(staging.stg_users(df, "2024-02-01"), "age_group") == [("18-24",)]
    assert rows(cleaning.clean_latest_per_id(df), "age_group") == [("55+",)]


def test_latest_per_id_settles_ties_alike(spark):
    copies = [user(1, _loaded_at=T1, payment_method=str(n)) for n in range(30)]
    df = frame(spark, "users", *copies)
    picks = {tuple(rows(cleaning.clean_latest_per_id(df.repartition(n)), "payment_method")) for n in (1, 3, 8)}
    assert len(picks) == 1


def test_invalid_duration(spark):
    df = frame(
        spark,
        "viewing_sessions",
        session(1, seconds=0, _loaded_at=T1),
        session(2, seconds=-5, _loaded_at=T1),
        session(3, seconds=5, _loaded_at=T1),
        session(4, seconds=0, _loaded_at="2024-01-05 00:00:00"),
        session(5, seconds=0),
        session(6, seconds=None, _loaded_at=T1),
    )
    assert rows(cleaning.clean_invalid_duration(df, "2024-01-06"), "id") == [(3,), (4,), (5,), (6,)]


def test_staged_sessions(spark):
    df = frame(
        spark,
        "viewing_sessions",
        session(1, start="2024-01-05 23:59:59"),
        session(2, start="2024-01-06 00:00:00"),
        session(3, seconds=0),
        session(4, start=None),
        session(5, seconds=None),
    )
    assert rows(staging.stg_viewing_sessions(df), "viewing_session_id") == [(2,)]


@pytest.mark.parametrize("as_of, status", [("2024-02-09", "Active"), ("2024-02-10", "Inactive")])
def test_engagement_status_counts_calendar_days(spark, as_of, status):
    users = frame(spark, "users", user(1), user(2))
    sessions = frame(spark, "viewing_sessions", session(1, start="2024-01-10 23:59:00"))
    dim = core.dim_users(users, sessions, frame(spark, "subscription_events"), as_of)
    assert rows(dim, "user_key", "engagement_status") == [(1, status), (2, "Never Watched")]


def test_dim_users(spark):
    plans = ["premium", "family", "ultimate", "free_trial", "standard", None]
    users = frame(spark, "users", *(user(i, subscription_plan=p) for i, p in enumerate(plans)), user(9), user(9, last_name=None))
    events = frame(
        spark,
        "subscription_events",
        *(dict(id=i, user_id=0, event_type=t, event_date=f"2024-01-0{i}") for i, t in
          [(1, "subscription_start"), (2, "cancellation"), (3, "cancellation"), (4, None)]),
    )
    sessions = frame(spark, "viewing_sessions", session(1, 0, rate=None, seconds=5), session(2, 0, rate="20.50", seconds=6))
    dim = core.dim_users(users, sessions, events, "2024-02-01")
    assert rows(dim.where("user_key < 9"), "user_key", "customer_tier") == [
        (0, "Premium"), (1, "Premium"), (2, "Premium"), (3, "Free Trial"), (4, "Basic"), (5, "Basic"),
    ]
    assert rows(dim.where("user_key = 9"), "full_name", "country_code") == [("A B", "FRA"), (None, "FRA")]
    first = dim.where("user_key = 0").first()
    assert (first.subscription_starts, first.cancellations) == (1, 2)
    assert (first.total_viewing_sessions, first.total_watch_time_seconds, first.avg_completion_rate) == (2, 11, 20.5)
    second = dim.where("user_key = 1").first()
    assert (second.cancellations, second.avg_completion_rate, second.last_viewing_date) == (0, 0.0, None)


def test_completion_status(spark):
    rates = {1: None, 2: "49.99", 3: "50.00", 4: "89.99", 5: "90.00"}
    df = frame(spark, "viewing_sessions", *(session(i, rate=r) for i, r in rates.items()))
    fact = core.fact_viewing_sessions(staging.stg_viewing_sessions(df))
    assert [s for _, s in rows(fact, "viewing_session_key", "completion_status")] == [
        "Abandoned", "Abandoned", "Partial", "Partial", "Complete",
    ]


def test_content_stats_keep_the_group_without_content(spark):
    df = frame(
        spark,
        "viewing_sessions",
        session(1, user_id=1, content_id=None),
        session(2, user_id=None, content_id=None),
        session(3, user_id=1, content_id=2),
        session(4, user_id=1, content_id=2),
    )
    stats = core.content_viewing_stats(staging.stg_viewing_sessions(df))
    assert rows(stats, "content_id", "total_sessions", "unique_viewers") == [(2, 2, 1), (None, 2, 1)]


def watched(spark, seconds):
    """One title per entry, watched for that long in one session."""
    sessions = frame(spark, "viewing_sessions", *(session(i, content_id=i, seconds=s) for i, s in enumerate(seconds, 1)))
    content = frame(spark, "content", *(title(i, imdb_rating="8.0") for i in range(1, len(seconds) + 1)))
    return sessions, content


def test_ties_in_watch_time(spark):
    sessions, content = watched(spark, [100, 300, 100, 100])
    mart = marts.mart_content_performance(staging.stg_viewing_sessions(sessions), staging.stg_content(content))
    assert rows(mart, "watch_time_rank", "content_id", "cumulative_watch_time", "abc_class") == [
        (1, 2, 300, "A"), (2, 1, 400, "A"), (3, 3, 500, "B"), (4, 4, 600, "C"),
    ]
    assert rows(mart.where("content_id = 2"), "watch_time_pct", "content_score") == [(50.0, round(50 * 0.4 + 8 * 0.3, 2))]


def test_no_watch_time_at_all(spark):
    sessions, content = watched(spark, [1, 1])
    nothing = staging.stg_viewing_sessions(sessions).withColumn("duration_seconds", F.lit(0))
    mart = marts.mart_content_performance(nothing, staging.stg_content(content))
    assert rows(mart, "watch_time_pct", "cumulative_watch_time_pct", "abc_class") == [(None, None, "C")] * 2


def test_popularity_tiers(spark):
    ranked = spark.range(1, 103).select(F.col("id").alias("watch_time_rank"))
    tiers = dict(rows(marts.popularity_tier(ranked)))
    assert [tiers[r] for r in (1, 10, 11, 50, 51, 100, 101)] == [
        "Top 10", "Top 10", "Top 50", "Top 50", "Top 100", "Top 100", "Long Tail",
    ]


def test_repeated_catalogue_rows_multiply_sessions(spark):
    sessions, _ = watched(spark, [100, 300])
    content = staging.stg_content(frame(spark, "content", title(1), title(1), title(2), title(2, title="other")))
    stg = staging.stg_viewing_sessions(sessions)
    got = marts.content_performance_agg(stg, content)
    joined = stg.join(content.drop("_loaded_at"), "content_id").groupBy("content_id", "title")
    want = joined.agg(F.count("*"), F.count_distinct("user_id"), F.sum("duration_seconds"))
    columns = ["content_id", "title", "total_sessions", "unique_viewers", "total_watch_time_seconds"]
    assert rows(got, *columns) == rows(want)


def test_engagement_of_unknown_age_group(spark):
    users = staging.stg_users(frame(spark, "users", user(1), user(2, age_group="55+")), "2024-02-01")
    sessions = staging.stg_viewing_sessions(
        frame(
            spark,
            "viewing_sessions",
            session(1, 1, 1, platform="mobile_ios", quality="4K"),
            session(2, 1, 2, platform="web", quality="HDR"),
            session(3, 2, 2, platform="smart_tv", quality="Full HD", rate=None),
            session(4, 3, 2, platform="smart_tv"),  # unknown user
        )
    )
    mart = marts.mart_user_engagement(sessions, users)
    columns = ["customer_tier", "total_sessions", "unique_content_viewed", "daily_active_users", "high_quality_sessions"]
    assert rows(mart, *columns, "web_sessions_pct", "avg_completion_rate", "avg_buffering_count") == [
        ("55+", 1, 1, 1, 0, 0.0, None, None),
        (None, 2, 2, 1, 2, 50.0, 50.0, None),
    ]


def test_event_counts_keep_missing_users(spark):
    events = frame(
        spark,
        "subscription_events",
        *(dict(id=i, user_id=u, event_type=t, event_date="2024-01-01") for i, (u, t) in
          enumerate([(1, "upgrade"), (1, "upgrade"), (1, None), (None, "upgrade"), (None, "upgrade"), (None, None)])),
    )
    mart = marts.mart_subscription_analytics(staging.stg_subscription_events(events))
    assert rows(mart, "user_id", "event_type", "event_count") == [
        (1, "upgrade", 2), (1, "upgrade", 2), (1, None, 1), (None, "upgrade", 2), (None, "upgrade", 2), (None, None, 1),
    ]


def test_popular_content_counts_pairs(spark):
    content = frame(spark, "content", title(1), title(2), title(3))
    sessions = frame(spark, "viewing_sessions", session(1, rate="10.00"), session(2, rate="20.00"), session(3, content_id=2))
    ratings = frame(spark, "ratings", *(dict(id=i, user_id=i, content_id=1, rating=i) for i in (1, 2, 3)))
    got = reports.popular_content(content, sessions, ratings, min_views=1)
    assert rows(got, "id", "view_count", "avg_completion", "avg_rating") == [(1, 6, 15.0, 2.0), (2, 1, 50.0, None)]
    assert reports.popular_content(content, sessions, ratings, min_views=7).count() == 0


def test_reports_of_nothing(spark):
    sessions, ratings, users = (frame(spark, t) for t in ("viewing_sessions", "ratings", "users"))
    assert rows(reports.verify_watch_hours(sessions)) == [(0.0,)]
    assert rows(reports.verify_avg_rating(ratings)) == [(0.0,)]
    assert rows(reports.verify_avg_completion(sessions)) == [(0.0,)]
    assert rows(reports.plan_share(users)) == [] and rows(reports.total_users(users)) == [(0,)]
    assert reports.daily_engagement(sessions).count() == 0
    mart = marts.mart_content_performance(staging.stg_viewing_sessions(sessions), staging.stg_content(frame(spark, "content")))
    assert mart.count() == 0


def test_missing_rating_comes_first(spark):
    content = frame(spark, "content", title(1, imdb_rating="9.9"), title(2), title(3, imdb_rating="1.0"))
    assert [r.id for r in reports.top_rated_content(content, 2).collect()] == [2, 1]


def test_report_order(spark):
    sessions = frame(spark, "viewing_sessions", *(session(i, start=f"2024-01-{10 + i} 00:00:00") for i in range(1, 10)))
    days = [r.viewing_date for r in reports.last_7_days(sessions).collect()]
    assert days == [dt.date(2024, 1, 19 - i) for i in range(7)]


def test_active_users(spark):
    users = frame(
        spark,
        "users",
        user(1, last_login="2024-01-02 00:00:00", is_active=True),
        user(2, last_login="2024-01-01 23:59:59", is_active=True),
        user(3, last_login="2024-01-20 00:00:00", is_active=False),
        user(4, is_active=True),
        user(5, last_login="2024-01-20 00:00:00"),
    )
    assert rows(reports.active_users(users, "2024-02-01"), "id") == [(1,)]


def test_age_groups(spark):
    people = spark.createDataFrame([(2024 - a,) for a in (5, 13, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 90)] + [(None,)], "birth_year int")
    groups = [g for _, g in derivations.derive_age_group(people, "2024-06-01").collect()]
    assert groups == ["13-17"] * 3 + ["18-24"] * 2 + ["25-34"] * 2 + ["35-44"] * 2 + ["45-54"] * 2 + ["55+"] * 2 + [None]


def test_completion_is_capped(spark):
    sessions = frame(spark, "viewing_sessions", session(1, seconds=60), session(2, seconds=10**6), session(3, content_id=8))
    done = derivations.derive_completion(sessions, frame(spark, "content", title(1, duration_minutes=3)))
    assert rows(done, "id", "completion_rate", "session_end")[0] == (1, Decimal("33.33"), dt.datetime(2024, 1, 10, 10, 1))
    assert rows(done, "id", "completion_rate")[1:] == [(2, Decimal("100.00"))]


def test_plan_changes(spark):
    events = spark.createDataFrame(
        [("basic", "family"), ("premium", "standard"), ("basic", "basic"), (None, "basic"), ("basic", "other")],
        "previous_plan string, new_plan string",
    )
    changes = [r.plan_change for r in derivations.classify_plan_change(events).collect()]
    assert changes == ["upgrade", "downgrade", "same", None, None]
