"""Marts: content performance, daily user engagement, subscription events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchlytics.functions.aggregates import merged_over
from watchlytics.functions.joins import lookup_join
from watchlytics.functions.numbers import hundredths, mean, ratio_round
from watchlytics.functions.ordering import range_buckets, rank_and_running_total
from watchlytics.functions.stamps import with_updated_at

TITLE_COLUMNS = [
    "content_id",
    "title",
    "content_type",
    "genre",
    "subgenre",
    "release_year",
    "duration_minutes",
    "is_original",
]

# --- fixed values: class borders, rank cuts and score weights ----------------
CLASS_BORDERS = {"A": 80.0, "B": 95.0}
LAST_CLASS = "C"
RANK_CUTS = {"Top 10": 10, "Top 50": 50, "Top 100": 100}
LAST_TIER = "Long Tail"
SCORE_WEIGHTS = {"completion": 0.4, "rating": 0.3, "sessions": 0.3}


# --- content performance -----------------------------------------------------


def content_performance_agg(stg_sessions: DataFrame, stg_content: DataFrame) -> DataFrame:
    """Viewing figures of every watched title.

    Sessions are read once and aggregated per content and user, then per content, before they meet the
    catalogue: the join moves one row per content instead of one per session. Catalogue rows
    repeated in all their columns add up, as they would in a join of the
    single sessions.
    """
    watched = merged_over(
        stg_sessions,
        {"content_id": F.col("content_id")},
        "user_id",
        "viewers",
        {
            "sessions": ("count", F.lit(1)),
            "seconds": ("sum", F.col("duration_seconds").cast("bigint")),
            "completion": ("sum", hundredths(F.col("completion_rate"))),
            "completions": ("count", F.col("completion_rate")),
            "first": ("min", F.col("session_start")),
            "last": ("max", F.col("session_start")),
        },
    )
    titles = stg_content.groupBy(*TITLE_COLUMNS, "imdb_rating").agg(F.count("*").alias("copies"))
    return lookup_join(titles, watched, ["content_id"]).select(
        *TITLE_COLUMNS,
        (F.col("sessions") * F.col("copies")).alias("total_sessions"),
        F.col("viewers").alias("unique_viewers"),
        (F.col("seconds") * F.col("copies")).alias("total_watch_time_seconds"),
        mean(F.col("completion"), F.col("completions"), 100).alias("avg_completion_rate"),
        F.col("imdb_rating").alias("avg_rating"),
        F.lit(0).alias("total_ratings"),
        F.lit(0).alias("five_star_ratings"),
        F.col("first").alias("first_viewing_date"),
        F.col("last").alias("last_viewing_date"),
    )


def _by_watch_time() -> list[Column]:
    # The title columns settle equal watch times, so that every run agrees.
    return [F.col("total_watch_time_seconds").desc(), *(F.col(c) for c in TITLE_COLUMNS), F.col("avg_rating")]


def ranked_watch_time(performance: DataFrame) -> DataFrame:
    """Add rank, running and grand total of watch time, longest first.

    All three come from one pass over a range-partitioned copy; no task sees
    the whole table.
    """
    return rank_and_running_total(
        range_buckets(performance, _by_watch_time()),
        _by_watch_time(),
        "total_watch_time_seconds",
        rank="watch_time_rank",
        running="cumulative_watch_time",
        total="total_watch_time_all",
    )


def watch_time_rank(performance: DataFrame) -> DataFrame:
    """Add the rank by watch time."""
    return ranked_watch_time(performance).drop("cumulative_watch_time", "total_watch_time_all")


def cumulative_watch_time(performance: DataFrame) -> DataFrame:
    """Add the running sum of watch time, longest first."""
    return ranked_watch_time(performance).drop("watch_time_rank", "total_watch_time_all")


def total_watch_time_all(performance: DataFrame) -> DataFrame:
    """Add the grand total of watch time to every row."""
    total = performance.agg(F.sum("total_watch_time_seconds")).scalar()
    return performance.withColumn("total_watch_time_all", total)


def watch_time_share(ranked: DataFrame) -> DataFrame:
    """Add own and cumulative share of all watch time in percent."""
    total = F.col("total_watch_time_all")
    return ranked.withColumns(
        {
            "watch_time_pct": ratio_round(F.col("total_watch_time_seconds") * 100, total, 3),
            "cumulative_watch_time_pct": ratio_round(F.col("cumulative_watch_time") * 100, total, 2),
        }
    )


def abc_class(shares: DataFrame, borders: dict[str, float] = CLASS_BORDERS) -> DataFrame:
    """Add the class by cumulative share; an unknown share belongs to the last class."""
    name = F.lit(LAST_CLASS)
    for label, border in sorted(borders.items(), key=lambda item: -item[1]):
        name = F.when(F.col("cumulative_watch_time_pct") <= border, label).otherwise(name)
    return shares.withColumn("abc_class", name)


def popularity_tier(ranked: DataFrame, cuts: dict[str, int] = RANK_CUTS) -> DataFrame:
    """Add the tier by rank."""
    name = F.lit(LAST_TIER)
    for label, cut in sorted(cuts.items(), key=lambda item: -item[1]):
        name = F.when(F.col("watch_time_rank") <= cut, label).otherwise(name)
    return ranked.withColumn("popularity_tier", name)


def content_score(performance: DataFrame, weights: dict[str, float] = SCORE_WEIGHTS) -> DataFrame:
    """Add the weighted score of completion, rating and number of sessions."""
    completion = F.coalesce("avg_completion_rate", F.lit(0.0))
    rating = F.coalesce(F.col("avg_rating").cast("double"), F.lit(0.0))
    sessions = F.ln(F.greatest(F.coalesce("total_sessions", F.lit(1)), F.lit(1)).cast("double"))
    score = completion * weights["completion"] + rating * weights["rating"] + sessions * weights["sessions"]
    return performance.withColumn("content_score", F.round(score, 2))


def mart_content_performance(stg_sessions: DataFrame, stg_content: DataFrame, updated_at=None) -> DataFrame:
    """Content mart. Stored unordered; readers sort by ``watch_time_rank``."""
    ranked = ranked_watch_time(content_performance_agg(stg_sessions, stg_content))
    return with_updated_at(content_score(popularity_tier(abc_class(watch_time_share(ranked)))), updated_at)


# --- user engagement ---------------------------------------------------------


def daily_engagement_agg(stg_sessions: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Activity per day, country, age group and plan of known users.

    ``customer_tier`` is the age group, a name the consumers of this table know.
    Sessions shrink to one row per day, user and title inside the map tasks, so a hot user
    is no burden, and again to one per day and user before they meet the users. Both steps
    keep the sums exact; a user listed several times counts once as a viewer and with all
    sessions per listing, as in a join of the single sessions.
    """
    platform, quality = F.col("platform"), F.col("quality")
    sums = {
        "total_sessions": F.count("*"),
        "seconds": F.sum(F.col("duration_seconds").cast("bigint")),
        "completion": F.sum(hundredths(F.col("completion_rate"))),
        "completions": F.count("completion_rate"),
        "buffering": F.sum(F.col("buffering_count").cast("bigint")),
        "bufferings": F.count("buffering_count"),
        "web_sessions": F.count_if(platform == "web"),
        "mobile_sessions": F.count_if(platform.like("mobile%")),
        "tv_sessions": F.count_if(platform == "smart_tv"),
        "high_quality_sessions": F.count_if(quality.isin("4K", "HDR")),
        "full_hd_sessions": F.count_if(quality == "Full HD"),
        "hd_sessions": F.count_if(quality == "HD"),
        "sd_sessions": F.count_if(quality == "SD"),
    }
    per_title = stg_sessions.groupBy(F.to_date("session_start").alias("engagement_date"), "user_id", "content_id").agg(
        *(column.alias(name) for name, column in sums.items())
    )
    profiles = stg_users.select(
        "user_id", F.col("country").alias("country_code"), F.col("age_group").alias("customer_tier"), "subscription_plan"
    )
    joined = lookup_join(per_title, profiles, ["user_id"], hot=True)
    group = ["engagement_date", "country_code", "customer_tier", "subscription_plan"]
    totals = [F.sum(name).alias(name) for name in sums]
    per_user = joined.groupBy(*group, "user_id").agg(*totals)
    figures = per_user.groupBy(*group).agg(F.count("user_id").alias("daily_active_users"), *totals)
    titles = joined.select(*group, "content_id").distinct().groupBy(*group).agg(F.count("content_id").alias("unique_content_viewed"))
    found = lookup_join(figures, titles, group, null_safe=True)
    return found.select(
        *group,
        "daily_active_users",
        "unique_content_viewed",
        "total_sessions",
        F.col("seconds").alias("total_watch_time_seconds"),
        mean(F.col("completion"), F.col("completions"), 100).alias("avg_completion_rate"),
        mean(F.col("buffering"), F.col("bufferings")).alias("avg_buffering_count"),
        *(c for c in sums if c.endswith("_sessions") and c != "total_sessions"),
    )


def engagement_ratios(engagement: DataFrame) -> DataFrame:
    """Add hours, sessions per user, mean duration and platform shares."""
    seconds, sessions = F.col("total_watch_time_seconds"), F.col("total_sessions")
    shares = {
        f"{name}_sessions_pct": ratio_round(F.col(f"{name}_sessions") * 100, sessions, 1)
        for name in ("web", "mobile", "tv")
    }
    return engagement.withColumns(
        {
            "total_watch_time_hours": ratio_round(seconds, F.lit(3600), 2),
            "sessions_per_user": ratio_round(sessions, F.col("daily_active_users"), 2),
            "avg_session_duration_seconds": ratio_round(seconds, sessions, 2),
            **shares,
        }
    )


def mart_user_engagement(stg_sessions: DataFrame, stg_users: DataFrame, updated_at=None) -> DataFrame:
    """Engagement mart. Stored unordered; readers sort by day and watch time."""
    return with_updated_at(engagement_ratios(daily_engagement_agg(stg_sessions, stg_users)), updated_at)


# --- subscription events -----------------------------------------------------


def subscription_event_count(stg_events: DataFrame) -> DataFrame:
    """Every event with the number of events of its user and type.

    Counts are aggregated first and joined back: adaptive execution splits the join for a
    user with very many events, whom a window would put into one task.
    """
    keys = ["user_id", "event_type"]
    counts = stg_events.groupBy(*keys).agg(F.count("*").alias("event_count"))
    events = stg_events.select(
        "user_id", "event_type", F.col("event_at").alias("event_date"), "previous_plan", "new_plan"
    )
    return lookup_join(events, counts, keys, null_safe=True, hot=True)


def mart_subscription_analytics(stg_events: DataFrame, updated_at=None) -> DataFrame:
    """Subscription mart. Stored unordered; readers sort by date and user."""
    return with_updated_at(subscription_event_count(stg_events), updated_at)
