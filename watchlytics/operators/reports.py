"""Application views, everyday reports and the summary of a data set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from watchlytics.functions.aggregates import with_distinct_count
from watchlytics.functions.joins import lookup_join
from watchlytics.functions.numbers import hundredths, mean, mean_of, mean_of_hundredths, ratio_round

# --- application views -------------------------------------------------------


def active_users(users: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Active accounts that logged in during the last ``days`` days."""
    since = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return users.where((F.col("last_login") >= since) & F.col("is_active"))


def _views(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("content_id").agg(
        F.count("id").alias("views"),
        F.sum(hundredths(F.col("completion_rate"))).alias("completion"),
        F.count("completion_rate").alias("completions"),
    )


def _titles(content: DataFrame) -> DataFrame:
    # Equal rows of one title are counted, not kept.
    return content.groupBy(F.col("id").alias("content_id"), "title", "content_type", "genre").agg(
        F.count("*").alias("copies")
    )


def popular_content(content: DataFrame, sessions: DataFrame, ratings: DataFrame, min_views: int = 1000) -> DataFrame:
    """Titles with at least ``min_views`` views, most viewed first.

    A view counts once per rating of its title, as in a join of both child
    tables. The pairs are never built: each child is aggregated per content and
    the counts are multiplied. The means do not change, as every session
    meets the same number of ratings and the reverse.
    """
    rated = ratings.groupBy("content_id").agg(
        F.count("*").alias("ratings"),
        F.sum(F.col("rating").cast("bigint")).alias("stars"),
        F.count("rating").alias("rated"),
    )
    one = F.lit(1)
    view_count = F.col("copies") * F.coalesce("views", F.lit(0)) * F.greatest(F.coalesce("ratings", one), one)
    return (
        lookup_join(lookup_join(_titles(content), _views(sessions), ["content_id"], "left"), rated, ["content_id"], "left")
        .select(
            F.col("content_id").alias("id"),
            "title",
            "content_type",
            "genre",
            view_count.alias("view_count"),
            mean(F.col("completion"), F.col("completions"), 100).alias("avg_completion"),
            mean(F.col("stars"), F.col("rated")).alias("avg_rating"),
        )
        .where(F.col("view_count") >= min_views)
        .orderBy(F.desc("view_count"), "id")
    )


def daily_engagement(sessions: DataFrame) -> DataFrame:
    """Active users, sessions, watch time and completion per day, newest first."""
    per_day = with_distinct_count(
        sessions,
        {"viewing_date": F.to_date("session_start")},
        "user_id",
        "daily_active_users",
        [
            F.count("*").alias("total_sessions"),
            F.sum(F.col("duration_seconds").cast("bigint")).alias("total_watch_time_seconds"),
            mean_of_hundredths(F.col("completion_rate")).alias("avg_completion_rate"),
        ],
    )
    return per_day.orderBy(F.desc_nulls_first("viewing_date"))


# --- ad-hoc reports ----------------------------------------------------------


def total_users(users: DataFrame) -> DataFrame:
    """Number of users."""
    return users.agg(F.count("*").alias("total_users"))


def users_sample(users: DataFrame, n: int = 5) -> DataFrame:
    """A few users to look at."""
    return users.select("id", "email", "username", "country", "subscription_plan").orderBy("id").limit(n)


def top_content(content: DataFrame, sessions: DataFrame, n: int = 10) -> DataFrame:
    """The most viewed titles. Sessions are aggregated per content before the join."""
    return (
        lookup_join(_titles(content), _views(sessions), ["content_id"])
        .select(
            "content_id",
            "title",
            "content_type",
            "genre",
            (F.col("views") * F.col("copies")).alias("view_count"),
            mean(F.col("completion"), F.col("completions"), 100).alias("avg_completion"),
        )
        .orderBy(F.desc("view_count"), "content_id")
        .limit(n)
        .drop("content_id")
    )


def last_7_days(sessions: DataFrame, n: int = 7) -> DataFrame:
    """Active users, sessions and hours of the newest ``n`` days with sessions."""
    seconds = F.sum(F.col("duration_seconds").cast("bigint"))
    per_day = with_distinct_count(
        sessions,
        {"viewing_date": F.to_date("session_start")},
        "user_id",
        "daily_active_users",
        [F.count("*").alias("total_sessions"), ratio_round(seconds, F.lit(3600), 1).alias("total_hours_watched")],
    )
    return per_day.orderBy(F.desc_nulls_first("viewing_date")).limit(n)


# --- summary of a data set ---------------------------------------------------

# --- fixed values: labels of the summary, per table; a condition counts a part
SUMMARY_LABELS: dict[str, dict[str, str | None]] = {
    "users": {"Utilisateurs": None, "Utilisateurs actifs": "is_active"},
    "content": {
        "Contenus": None,
        "Films": "content_type = 'movie'",
        "Séries TV": "content_type = 'tv_show'",
        "Documentaires": "content_type = 'documentary'",
    },
    "viewing_sessions": {"Sessions de visionnage": None},
    "ratings": {"Évaluations": None},
    "watchlist": {"Liste de visionnage": None},
    "subscription_events": {"Événements d'abonnement": None},
    "search_queries": {"Requêtes de recherche": None},
    "episodes": {"Épisodes": None},
    "episode_viewing": {"Visionnages d'épisodes": None},
}
TOTAL_LABEL = "TOTAL"


def _labelled_counts(df: DataFrame, conditions: dict[str, str | None]) -> DataFrame:
    """One row per label with its count, from a single pass over ``df``."""
    counts: list[Column] = [
        F.struct(
            F.lit(label).alias("label"),
            (F.count("*") if condition is None else F.count_if(F.expr(condition))).alias("n"),
        )
        for label, condition in conditions.items()
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def verify_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts of all tables and the total of the labelled counts."""
    parts = [_labelled_counts(tables[name], conditions) for name, conditions in SUMMARY_LABELS.items()]
    counts = reduce(DataFrame.unionByName, parts)
    return counts.rollup("label").agg(F.sum("n").alias("n")).select(
        F.coalesce("label", F.lit(TOTAL_LABEL)).alias("label"), "n"
    )


def verify_watch_hours(sessions: DataFrame) -> DataFrame:
    """Hours watched in all sessions, 0 without any."""
    seconds = F.coalesce(F.sum(F.col("duration_seconds").cast("bigint")), F.lit(0))
    return sessions.agg((seconds.cast("double") / 3600).alias("total_hours"))


def verify_avg_rating(ratings: DataFrame) -> DataFrame:
    """Mean rating, 0 without any."""
    return ratings.agg(F.coalesce(mean_of(F.col("rating")), F.lit(0.0)).alias("avg_rating"))


def verify_avg_completion(sessions: DataFrame) -> DataFrame:
    """Mean completion rate, 0 without any."""
    rate = mean_of_hundredths(F.col("completion_rate"))
    return sessions.agg(F.coalesce(rate, F.lit(0.0)).alias("avg_completion"))


def plan_share(users: DataFrame) -> DataFrame:
    """Users per plan and their share in percent, largest first."""
    plans = users.groupBy("subscription_plan").agg(F.count("*").alias("n"))
    total = plans.agg(F.sum("n")).scalar()
    return plans.select(
        "subscription_plan", "n", ratio_round(F.col("n") * 100, total, 1).alias("percentage")
    ).orderBy(F.desc("n"), "subscription_plan")


# --- selections --------------------------------------------------------------


def _first(df: DataFrame, key: str, n: int | None) -> DataFrame:
    return df if n is None else df.orderBy(key).limit(n)


def eligible_users(users: DataFrame, n: int | None = None) -> DataFrame:
    """Active users: all, or the first ``n`` by id."""
    return _first(users.where("is_active").select("id"), "id", n)


def distinct_viewers(sessions: DataFrame, n: int | None = None) -> DataFrame:
    """Users who watched something: all, or the first ``n`` by id."""
    return _first(sessions.where("user_id IS NOT NULL").select("user_id").distinct(), "user_id", n)


def top_rated_content(content: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` titles rated best; titles without a rating come first, as in the source database."""
    return (
        content.select("id", "duration_minutes", "imdb_rating")
        .orderBy(F.col("imdb_rating").desc_nulls_first(), "id")
        .limit(n)
        .drop("imdb_rating")
    )


def tv_show_sessions(sessions: DataFrame, content: DataFrame, n: int | None = None) -> DataFrame:
    """Sessions of TV shows: all, or the first ``n`` by id."""
    shows = content.where("content_type = 'tv_show'").select(F.col("id").alias("content_id")).distinct()
    viewed = sessions.select("id", "user_id", "content_id")
    return _first(lookup_join(viewed, shows, ["content_id"], hot=True).select("id", "user_id"), "id", n)
