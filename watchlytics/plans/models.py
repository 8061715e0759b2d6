"""All models of one run as DataFrames over the nine source tables.

They are lazy but for the content mart, which checkpoints its aggregate when it
is built (see ``functions/ordering.py``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from watchlytics.operators import core, marts, reports, staging
from watchlytics.schemas import ACTIVE_DAYS, PREMIUM_PLANS, START_DATE


# Columns by whose values a stored model is cut into folders; filters on them open only the folders they need.
PARTITIONS = {"fact_viewing_sessions": "date_key", "mart_user_engagement": "engagement_date"}


@dataclass(frozen=True)
class Parameters:
    """What a run depends on besides its tables."""

    as_of: str  # day of the run, yyyy-mm-dd
    start_date: str = START_DATE
    active_days: int = ACTIVE_DAYS
    premium_plans: list[str] = field(default_factory=lambda: list(PREMIUM_PLANS))


def staging_models(raw: dict[str, DataFrame], p: Parameters) -> dict[str, DataFrame]:
    """The nine staging models."""
    return {
        "stg_users": staging.stg_users(raw["users"], p.as_of),
        "stg_content": staging.stg_content(raw["content"]),
        "stg_viewing_sessions": staging.stg_viewing_sessions(raw["viewing_sessions"], p.start_date),
        "stg_ratings": staging.stg_ratings(raw["ratings"]),
        "stg_watchlist": staging.stg_watchlist(raw["watchlist"]),
        "stg_subscription_events": staging.stg_subscription_events(raw["subscription_events"]),
        "stg_search_queries": staging.stg_search_queries(raw["search_queries"]),
        "stg_episodes": staging.stg_episodes(raw["episodes"]),
        "stg_episode_viewing": staging.stg_episode_viewing(raw["episode_viewing"]),
    }


def core_models(raw: dict[str, DataFrame], stg: dict[str, DataFrame], p: Parameters) -> dict[str, DataFrame]:
    """Dimensions and facts."""
    sessions = stg["stg_viewing_sessions"]
    return {
        "dim_users": core.dim_users(
            raw["users"],
            raw["viewing_sessions"],
            raw["subscription_events"],
            p.as_of,
            p.active_days,
            p.premium_plans,
            updated_at=p.as_of,
        ),
        "dim_content": core.dim_content(raw["content"], sessions, raw["ratings"], updated_at=p.as_of),
        "dim_date": core.dim_date(raw["viewing_sessions"]),
        "dim_platform": core.dim_platform(sessions),
        "fact_ratings": core.fact_ratings(stg["stg_ratings"]),
        "fact_viewing_sessions": core.fact_viewing_sessions(sessions, updated_at=p.as_of),
    }


def mart_models(stg: dict[str, DataFrame], p: Parameters) -> dict[str, DataFrame]:
    """The three marts."""
    sessions = stg["stg_viewing_sessions"]
    return {
        "mart_content_performance": marts.mart_content_performance(sessions, stg["stg_content"], p.as_of),
        "mart_user_engagement": marts.mart_user_engagement(sessions, stg["stg_users"], p.as_of),
        "mart_subscription_analytics": marts.mart_subscription_analytics(stg["stg_subscription_events"], p.as_of),
    }


def application_views(raw: dict[str, DataFrame], p: Parameters) -> dict[str, DataFrame]:
    """The views the application reads."""
    return {
        "active_users": reports.active_users(raw["users"], p.as_of, p.active_days),
        "popular_content": reports.popular_content(raw["content"], raw["viewing_sessions"], raw["ratings"]),
        "daily_engagement": reports.daily_engagement(raw["viewing_sessions"]),
    }
