"""Which days of the stored models a daily run has to write anew."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchlytics.plans.models import Parameters
from watchlytics.schemas import ddl
from watchlytics.sources.landing import exists, remove
from watchlytics.sources.staging_store import day_path

#: What the engagement mart takes from a user.
PROFILE = ["user_id", "country", "age_group", "subscription_plan"]


class ChangedDays:
    """Days whose rows of the session fact or the engagement mart may differ from those stored.

    A day changes if sessions of that day are loaded or replaced, whenever they are loaded, and for the engagement mart
    also if a user with a session that day is new, gone or has another profile than when the mart was written.
    Days are noted under ``<store>/changes`` before the data changes and stay there until the models are
    written, so a run that fails in between leaves nothing stale: the next one includes its days. Where the profiles
    of the last run are missing, or it had another start date, all days count as changed.
    """

    def __init__(self, spark: SparkSession, store: str, parameters: Parameters):
        self.spark, self.parameters = spark, parameters
        self.loaded = day_path(f"{store}/staging/viewing_sessions", parameters.as_of)
        self.noted, self.profiles = f"{store}/changes/days", f"{store}/changes/profiles"

    def note_sessions(self) -> None:
        """Note the days of the sessions that the load day holds now; called before and after it is replaced."""
        if exists(self.spark, self.loaded):
            sessions = self.spark.read.schema(ddl("viewing_sessions")).parquet(self.loaded)
            sessions.select(F.to_date("session_start").alias("day")).distinct().write.mode("append").parquet(self.noted)

    def _current(self, stg: dict[str, DataFrame]) -> DataFrame:
        return stg["stg_users"].select(*PROFILE, F.lit(str(self.parameters.start_date)).alias("start_date"))

    def _other_profiles(self, stg: dict[str, DataFrame]) -> DataFrame | None:
        """Users whose profiles are not those of the last run; None if these are unknown."""
        if not exists(self.spark, self.profiles):
            return None
        current = self._current(stg)
        before = self.spark.read.schema(current.schema).parquet(self.profiles)
        if before.where(F.col("start_date") != str(self.parameters.start_date)).limit(1).count():
            return None
        # Equal rows of both runs cancel out; what is left over differs.
        both = current.withColumn("side", F.lit(1)).unionByName(before.withColumn("side", F.lit(-1)))
        return both.groupBy(*PROFILE).agg(F.sum("side").alias("side")).where("side <> 0").select("user_id").distinct()

    def found(self, stg: dict[str, DataFrame]) -> dict[str, list[dt.date | None] | None]:
        """Changed days per stored model; None for all. There are never more than days in the history."""
        users = self._other_profiles(stg)
        if users is None:
            return {"fact_viewing_sessions": None, "mart_user_engagement": None}
        noted = self.spark.createDataFrame([], "day date")
        if exists(self.spark, self.noted):
            noted = self.spark.read.schema("day date").parquet(self.noted).distinct()
        sessions = stg["stg_viewing_sessions"].select("user_id", F.to_date("session_start").alias("day"))
        touched = sessions.join(users, "user_id", "left_semi").select("day").distinct()
        days = [row.day for row in noted.collect()]
        more = [row.day for row in touched.collect()]
        return {"fact_viewing_sessions": days, "mart_user_engagement": list({*days, *more})}

    def settle(self, stg: dict[str, DataFrame]) -> None:
        """All models are written: forget the days noted and keep the profiles they were written with."""
        self._current(stg).write.mode("overwrite").parquet(self.profiles)
        remove(self.spark, self.noted)
