"""Removal of duplicate and invalid staging rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchlytics.functions.joins import lookup_join


def on_day(ts: str, day: dt.date | str) -> Column:
    """Whether a timestamp falls on ``day``; NULL for a missing timestamp."""
    return F.to_date(ts) == F.lit(str(day)).cast("date")


def clean_latest_per_id(df: DataFrame, key: str = "id", ts: str = "_loaded_at", now=None) -> DataFrame:
    """The newest row of every key.

    ``now`` stands in for a missing load time. Equal load times are settled by
    a hash of the row, so that repeated runs agree. Every task drops all but one
    row per key before the shuffle, so a key with many copies stays harmless.
    """
    loaded = F.col(ts) if now is None else F.coalesce(ts, F.lit(str(now)).cast("timestamp_ntz"))
    newest = Window.partitionBy(key).orderBy(loaded.desc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def clean_delete_shared_load_ts(
    df: DataFrame, load_day: dt.date | str, key: str = "id", ts: str = "_loaded_at"
) -> DataFrame:
    """Delete every row whose load time also belongs to an outdated row of the day.

    Outdated are all rows of ``load_day`` except the newest per key. The
    deletion goes by load time alone, so current rows sharing it vanish too;
    :func:`clean_latest_per_id` is the row-wise alternative.
    """
    loads = df.where(on_day(ts, load_day)).groupBy(key, ts).agg(F.count("*").alias("copies"))
    newest = loads.groupBy(key).agg(F.max(ts).alias("newest"))
    outdated = (
        lookup_join(loads, newest, [key], null_safe=True)
        .where((F.col(ts) < F.col("newest")) | (F.col("copies") > 1))
        .select(ts)
        .distinct()
    )
    return df.join(outdated, ts, "left_anti").select(*df.columns)


def clean_invalid_duration(sessions: DataFrame, load_day: dt.date | str) -> DataFrame:
    """Delete sessions of one load day that lasted no time at all."""
    invalid = (F.col("duration_seconds") <= 0) & on_day("_loaded_at", load_day)
    return sessions.where(~F.coalesce(invalid, F.lit(False)))
