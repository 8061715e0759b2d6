"""Columns the application derives when it records users, sessions and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchlytics.functions.joins import lookup_join
from watchlytics.functions.numbers import ratio_round

# --- fixed values: upper age of each group, and the order of the plans -------
AGE_LIMITS = {17: "13-17", 24: "18-24", 34: "25-34", 44: "35-44", 54: "45-54"}
OLDEST_GROUP = "55+"
PLAN_LEVELS = {"free_trial": 0, "basic": 1, "standard": 2, "premium": 3, "family": 4}


def derive_age_group(people: DataFrame, as_of, birth_year: str = "birth_year") -> DataFrame:
    """Add ``age_group`` from the year of birth; children count to the youngest group."""
    age = F.year(F.lit(as_of).cast("date")) - F.col(birth_year)
    group = F.when(age.isNull(), None)
    for limit, name in AGE_LIMITS.items():
        group = group.when(age <= limit, name)
    return people.withColumn("age_group", group.otherwise(OLDEST_GROUP))


def derive_completion(sessions: DataFrame, content: DataFrame) -> DataFrame:
    """Add ``session_end`` and ``completion_rate`` to sessions of known content.

    ``sessions`` has id, user_id, content_id, session_start and
    duration_seconds. The rate is the watched share of the content's length in
    percent, at most 100.
    """
    lengths = content.groupBy(F.col("id").alias("content_id")).agg(
        F.max("duration_minutes").alias("duration_minutes")
    )
    length = F.col("duration_minutes").cast("bigint") * 60
    watched = F.least(F.col("duration_seconds").cast("bigint"), length)
    return lookup_join(sessions, lengths, ["content_id"], hot=True).select(
        "id",
        "user_id",
        "content_id",
        "session_start",
        F.expr("timestampadd(SECOND, duration_seconds, session_start)").alias("session_end"),
        "duration_seconds",
        ratio_round(watched * 100, length, 2).cast("decimal(5,2)").alias("completion_rate"),
    )


def _level(plan: str) -> Column:
    level = F.lit(None).cast("int")
    for name, number in PLAN_LEVELS.items():
        level = F.when(F.col(plan) == name, number).otherwise(level)
    return level


def classify_plan_change(events: DataFrame) -> DataFrame:
    """Add ``plan_change``: upgrade, downgrade, same, or NULL where a plan is missing."""
    before, after = _level("previous_plan"), _level("new_plan")
    change = F.when(after > before, "upgrade").when(after < before, "downgrade").when(after == before, "same")
    return events.withColumn("plan_change", change)
