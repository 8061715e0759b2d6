"""Declared schemas and business rules of the nine source tables.

Nothing is ever inferred: loaders, checks and the daily job all read these
declarations.
"""

from __future__ import annotations

# --- fixed values: columns and types of the nine tables, in file order -------
# varchar(n) is a string with a length limit that a load has to respect.
TABLES: dict[str, dict[str, str]] = {
    "users": {
        "id": "int",
        "email": "varchar(255)",
        "username": "varchar(100)",
        "first_name": "varchar(100)",
        "last_name": "varchar(100)",
        "country": "varchar(3)",
        "age_group": "varchar(20)",
        "subscription_plan": "varchar(20)",
        "subscription_start": "date",
        "subscription_end": "date",
        "created_at": "timestamp_ntz",
        "last_login": "timestamp_ntz",
        "is_active": "boolean",
        "payment_method": "varchar(50)",
        "device_preference": "varchar(50)",
    },
    "content": {
        "id": "int",
        "title": "varchar(255)",
        "content_type": "varchar(20)",
        "genre": "varchar(100)",
        "subgenre": "varchar(100)",
        "release_year": "int",
        "duration_minutes": "int",
        "director": "varchar(255)",
        "main_actor": "varchar(255)",
        "imdb_rating": "decimal(3,1)",
        "content_rating": "varchar(10)",
        "is_original": "boolean",
        "added_date": "date",
        "available_countries": "array<string>",
        "tags": "array<string>",
        "description": "string",
    },
    "viewing_sessions": {
        "id": "bigint",
        "user_id": "int",
        "content_id": "int",
        "session_start": "timestamp_ntz",
        "session_end": "timestamp_ntz",
        "duration_seconds": "int",
        "platform": "varchar(50)",
        "device_type": "varchar(50)",
        "quality": "varchar(20)",
        "completion_rate": "decimal(5,2)",
        "buffering_count": "int",
        "avg_bitrate": "int",
        "city": "varchar(100)",
        "ip_address": "varchar(45)",
    },
    "ratings": {
        "id": "int",
        "user_id": "int",
        "content_id": "int",
        "rating": "int",
        "rating_date": "timestamp_ntz",
        "review_text": "string",
        "helpful_count": "int",
    },
    "watchlist": {
        "id": "int",
        "user_id": "int",
        "content_id": "int",
        "added_date": "timestamp_ntz",
        "watched": "boolean",
        "watched_date": "timestamp_ntz",
    },
    "subscription_events": {
        "id": "int",
        "user_id": "int",
        "event_type": "varchar(50)",
        "event_date": "timestamp_ntz",
        "previous_plan": "varchar(20)",
        "new_plan": "varchar(20)",
        "amount": "decimal(10,2)",
        "currency": "varchar(3)",
        "payment_gateway": "varchar(50)",
        "transaction_id": "varchar(100)",
    },
    "search_queries": {
        "id": "bigint",
        "user_id": "int",
        "query_text": "varchar(500)",
        "search_date": "timestamp_ntz",
        "results_count": "int",
        "clicked_content_id": "int",
        "search_filters": "string",
        "session_id": "varchar(100)",
    },
    "episodes": {
        "id": "int",
        "tv_show_id": "int",
        "season_number": "int",
        "episode_number": "int",
        "title": "varchar(255)",
        "duration_minutes": "int",
        "release_date": "date",
        "director": "varchar(255)",
        "imdb_rating": "decimal(3,1)",
        "description": "string",
    },
    "episode_viewing": {
        "id": "bigint",
        "viewing_session_id": "bigint",
        "episode_id": "int",
        "user_id": "int",
        "start_time": "timestamp_ntz",
        "end_time": "timestamp_ntz",
        "duration_watched": "int",
        "completion_rate": "decimal(5,2)",
    },
}

# --- fixed values: allowed values of coded columns ---------------------------
AGE_GROUPS = ["13-17", "18-24", "25-34", "35-44", "45-54", "55+"]
SUBSCRIPTION_PLANS = ["free_trial", "basic", "standard", "premium", "family"]
CONTENT_TYPES = ["movie", "tv_show", "documentary", "short_film", "original"]
CONTENT_RATINGS = ["G", "PG", "PG-13", "R", "NC-17"]
PLATFORMS = ["web", "mobile_ios", "mobile_android", "smart_tv", "game_console", "tablet"]
DEVICE_TYPES = ["desktop", "laptop", "phone", "tablet", "tv", "console"]
QUALITIES = ["SD", "HD", "Full HD", "4K", "HDR"]
EVENT_TYPES = ["subscription_start", "upgrade", "downgrade", "cancellation", "renewal", "payment_failed"]

# --- fixed values: defaults of the model parameters --------------------------
START_DATE = "2024-01-06"
ACTIVE_DAYS = 30
PREMIUM_PLANS = ["premium", "family", "ultimate"]


def spark_type(declared: str) -> str:
    """Spark type of a declared column type."""
    return "string" if declared.startswith("varchar") else declared


def ddl(table: str) -> str:
    """DDL schema string of one of the nine tables."""
    return ", ".join(f"{c} {spark_type(t)}" for c, t in TABLES[table].items())
