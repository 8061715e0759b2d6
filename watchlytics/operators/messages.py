"""Row counts after a load."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from watchlytics.operators.cleaning import on_day

# --- fixed values: texts of the load messages --------------------------------
LOADED = "Chargement {name} terminé : %d lignes"
LOADED_ON_DAY = "{name} chargé : %d nouvelles lignes"


def load_count_message(df: DataFrame, name: str) -> DataFrame:
    """Message with the number of rows of a loaded table."""
    return df.agg(F.format_string(LOADED.format(name=name), F.count("*")).alias("message"))


def load_count_message_day(df: DataFrame, name: str, day: dt.date | str) -> DataFrame:
    """Message with the number of rows loaded on one day."""
    text = LOADED_ON_DAY.format(name=name.upper())
    return df.where(on_day("_loaded_at", day)).agg(F.format_string(text, F.count("*")).alias("message"))


def row_count_recap(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = (
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)
