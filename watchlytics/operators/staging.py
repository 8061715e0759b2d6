"""Staging models: source tables under business names, lightly filtered."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchlytics.operators.cleaning import clean_latest_per_id
from watchlytics.schemas import START_DATE, TABLES


def _renamed(df: DataFrame, table: str, names: dict[str, str]) -> DataFrame:
    """All columns of ``table`` in file order and the load time, some under a new name."""
    return df.select(*(F.col(c).alias(names.get(c, c)) for c in [*TABLES[table], "_loaded_at"]))


def stg_users(users: DataFrame, as_of) -> DataFrame:
    """Newest load of every user."""
    return _renamed(clean_latest_per_id(users, now=as_of), "users", {"id": "user_id"})


def stg_content(content: DataFrame) -> DataFrame:
    """Catalogue."""
    return _renamed(content, "content", {"id": "content_id"})


def stg_viewing_sessions(sessions: DataFrame, start_date: str = START_DATE) -> DataFrame:
    """Sessions since ``start_date`` that lasted some time."""
    # A plain literal of the column's own type, so that the scan gets the filter.
    kept = sessions.where(
        (F.col("session_start") >= F.lit(str(start_date)).cast("timestamp_ntz")) & (F.col("duration_seconds") > 0)
    )
    return _renamed(kept, "viewing_sessions", {"id": "viewing_session_id"})


def stg_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings."""
    return _renamed(ratings, "ratings", {"id": "rating_id", "rating": "rating_value", "rating_date": "rated_at"})


def stg_watchlist(watchlist: DataFrame) -> DataFrame:
    """Watchlist entries."""
    return _renamed(watchlist, "watchlist", {"id": "watchlist_id", "added_date": "added_at"})


def stg_subscription_events(events: DataFrame) -> DataFrame:
    """Subscription events."""
    return _renamed(events, "subscription_events", {"id": "event_id", "event_date": "event_at"})


def stg_search_queries(searches: DataFrame) -> DataFrame:
    """Searches."""
    return _renamed(searches, "search_queries", {"id": "query_id"})


def stg_episodes(episodes: DataFrame) -> DataFrame:
    """Episodes."""
    return _renamed(episodes, "episodes", {"id": "episode_id"})


def stg_episode_viewing(views: DataFrame) -> DataFrame:
    """Viewings of episodes."""
    names = {
        "id": "episode_viewing_id",
        "start_time": "started_at",
        "end_time": "ended_at",
        "duration_watched": "duration_seconds",
    }
    return _renamed(views, "episode_viewing", names)
