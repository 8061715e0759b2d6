"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchlytics.functions.aggregates import merged_over
from watchlytics.functions.joins import lookup_join
from watchlytics.functions.numbers import hundredths, mean, mean_of, mean_of_hundredths
from watchlytics.functions.stamps import with_updated_at
from watchlytics.schemas import ACTIVE_DAYS, PREMIUM_PLANS


def _or_zero(column: str, kind: str = "bigint") -> Column:
    return F.coalesce(column, F.lit(0).cast(kind)).alias(column)


def user_viewing_stats(sessions: DataFrame) -> DataFrame:
    """First and last session, number, watch time and completion per user."""
    return sessions.groupBy("user_id").agg(
        F.min("session_start").alias("first_viewing_date"),
        F.max("session_start").alias("last_viewing_date"),
        F.count("id").alias("total_sessions"),
        F.sum(F.col("duration_seconds").cast("bigint")).alias("total_watch_time_seconds"),
        mean_of_hundredths(F.col("completion_rate")).alias("avg_completion_rate"),
    )


def user_subscription_stats(events: DataFrame) -> DataFrame:
    """First and last subscription event, starts and cancellations per user."""
    return events.groupBy("user_id").agg(
        F.min("event_date").alias("first_subscription_date"),
        F.max("event_date").alias("last_subscription_event_date"),
        F.count_if(F.col("event_type") == "subscription_start").alias("subscription_starts"),
        F.count_if(F.col("event_type") == "cancellation").alias("cancellations"),
    )


def dim_users(
    users: DataFrame,
    sessions: DataFrame,
    events: DataFrame,
    as_of,
    active_days: int = ACTIVE_DAYS,
    premium_plans: list[str] = PREMIUM_PLANS,
    updated_at=None,
) -> DataFrame:
    """User dimension with tier and engagement status as of a day.

    Reads unfiltered sessions, and every row of ``users``: reloaded users
    appear once per load.
    """
    viewing = user_viewing_stats(sessions).withColumnRenamed("user_id", "id")
    subscription = user_subscription_stats(events).withColumnRenamed("user_id", "id")
    known = lookup_join(lookup_join(users, viewing, ["id"], how="left"), subscription, ["id"], how="left")
    idle_days = F.datediff(F.lit(str(as_of)).cast("date"), F.to_date("last_viewing_date"))
    tier = (
        F.when(F.col("subscription_plan").isin(premium_plans), "Premium")
        .when(F.col("subscription_plan") == "free_trial", "Free Trial")
        .otherwise("Basic")
    )
    status = (
        F.when(idle_days <= active_days, "Active")
        .when(F.col("last_viewing_date").isNotNull(), "Inactive")
        .otherwise("Never Watched")
    )
    dim = known.select(
        F.col("id").alias("user_key"),
        "email",
        "username",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.upper("country").alias("country_code"),
        "age_group",
        "subscription_plan",
        "subscription_start",
        "subscription_end",
        "payment_method",
        tier.alias("customer_tier"),
        "is_active",
        "last_login",
        F.col("created_at").alias("registration_date"),
        "device_preference",
        _or_zero("total_sessions").alias("total_viewing_sessions"),
        _or_zero("total_watch_time_seconds"),
        _or_zero("avg_completion_rate", "double"),
        "first_viewing_date",
        "last_viewing_date",
        "first_subscription_date",
        "last_subscription_event_date",
        _or_zero("subscription_starts"),
        _or_zero("cancellations"),
        status.alias("engagement_status"),
    )
    return with_updated_at(dim, updated_at)


def content_viewing_stats(stg_sessions: DataFrame) -> DataFrame:
    """Sessions, viewers, watch time and completion per content."""
    stats = merged_over(
        stg_sessions,
        {"content_id": F.col("content_id")},
        "user_id",
        "unique_viewers",
        {
            "total_sessions": ("count", F.col("viewing_session_id")),
            "total_watch_time_seconds": ("sum", F.col("duration_seconds").cast("bigint")),
            "completion": ("sum", hundredths(F.col("completion_rate"))),
            "completions": ("count", F.col("completion_rate")),
        },
    )
    average = mean(F.col("completion"), F.col("completions"), 100).alias("avg_completion_rate")
    return stats.select("content_id", "total_sessions", "unique_viewers", "total_watch_time_seconds", average)


def content_rating_stats(ratings: DataFrame) -> DataFrame:
    """Number, mean and five-star count of ratings per content."""
    return ratings.groupBy("content_id").agg(
        F.count("*").alias("total_ratings"),
        mean_of(F.col("rating")).alias("avg_rating"),
        F.count_if(F.col("rating") == 5).alias("five_star_ratings"),
    )


def dim_content(content: DataFrame, stg_sessions: DataFrame, ratings: DataFrame, updated_at=None) -> DataFrame:
    """Content dimension with its viewing and rating figures; reads filtered sessions."""
    viewing = content_viewing_stats(stg_sessions).withColumnRenamed("content_id", "id")
    rating = content_rating_stats(ratings).withColumnRenamed("content_id", "id")
    known = lookup_join(lookup_join(content, viewing, ["id"], how="left"), rating, ["id"], how="left")
    dim = known.select(
        F.col("id").alias("content_key"),
        "title",
        "content_type",
        "genre",
        "subgenre",
        "description",
        "release_year",
        "duration_minutes",
        "director",
        "main_actor",
        "imdb_rating",
        "content_rating",
        "is_original",
        "added_date",
        "available_countries",
        "tags",
        _or_zero("total_sessions").alias("total_viewing_sessions"),
        _or_zero("unique_viewers"),
        _or_zero("total_watch_time_seconds"),
        _or_zero("avg_completion_rate", "double"),
        _or_zero("total_ratings"),
        _or_zero("avg_rating", "double"),
        _or_zero("five_star_ratings"),
    )
    return with_updated_at(dim, updated_at)


def dim_date(sessions: DataFrame) -> DataFrame:
    """Days with at least one session; reads unfiltered sessions."""
    days = sessions.select(F.to_date("session_start").alias("date")).distinct()
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "yyyy-MM-dd").alias("date_string"),
    )


def dim_platform(stg_sessions: DataFrame) -> DataFrame:
    """Platforms in use."""
    platforms = stg_sessions.select("platform").distinct()
    return platforms.select(F.col("platform").alias("platform_id"), F.col("platform").alias("platform_name"))


def fact_ratings(stg_ratings: DataFrame) -> DataFrame:
    """One row per rating, by day."""
    return stg_ratings.select(
        "rating_id", "user_id", "content_id", F.to_date("rated_at").alias("rating_date"), "rating_value"
    )


def fact_viewing_sessions(stg_sessions: DataFrame, updated_at=None) -> DataFrame:
    """One row per session with its completion status."""
    rate = F.col("completion_rate")
    status = F.when(rate >= 90, "Complete").when(rate >= 50, "Partial").otherwise("Abandoned")
    fact = stg_sessions.select(
        F.col("viewing_session_id").alias("viewing_session_key"),
        F.col("user_id").alias("user_key"),
        F.col("content_id").alias("content_key"),
        F.to_date("session_start").alias("date_key"),
        "platform",
        "device_type",
        "quality",
        "city",
        "session_start",
        "session_end",
        "duration_seconds",
        "completion_rate",
        "buffering_count",
        "avg_bitrate",
        status.alias("completion_status"),
    )
    return with_updated_at(fact, updated_at)
