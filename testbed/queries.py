"""Every operator applied to the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from testbed.bindings import (
    AS_OF,
    LOADED_AT,
    RELOADED_AT,
    driver_table,
    table,
    users_loaded_twice_a_day,
    users_reloaded,
)
from watchlytics.functions import derivations
from watchlytics.operators import cleaning, core, marts, messages, quality, reports, staging
from watchlytics.plans.daily import run_daily
from watchlytics.plans.models import Parameters, core_models, mart_models, staging_models
from watchlytics.schemas import TABLES
from watchlytics.session import new_folder
from watchlytics.sources import landing, loading, relational, staging_store
from watchlytics.streaming.incremental import land_incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOAD_DAY = LOADED_AT[:10]
RELOAD_DAY = RELOADED_AT[:10]


def query(run: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[run.__name__] = run
    return run


def joined_arrays(df: DataFrame) -> DataFrame:
    """Arrays as text, so that any client compares them alike."""
    return df.withColumns({c: F.array_join(c, "|") for c, t in df.dtypes if t.startswith("array")})


def all_tables(spark: SparkSession, sf: str, loaded: bool = True) -> dict[str, DataFrame]:
    return {name: table(spark, sf, name, loaded) for name in TABLES}


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_viewing_sessions(table(spark, sf, "viewing_sessions"))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_content(table(spark, sf, "content"))


def current_users(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_users(users_reloaded(spark, sf), AS_OF)


def performance(spark: SparkSession, sf: str) -> DataFrame:
    return marts.content_performance_agg(sessions(spark, sf), catalogue(spark, sf))


# --- sources and landing -----------------------------------------------------


def _stored(spark: SparkSession, sf: str, name: str) -> dict:
    """A store of parquet tables that holds the snapshot ``name``."""
    root = new_folder(spark, "store")
    table(spark, sf, name, loaded=False).write.parquet(f"{root}/{name}")
    return {"format": "parquet", "root": root}


def _with_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings whose review is the whole text of a document, line breaks and quotes included."""
    texts = driver_table(spark, sf, "documents").selectExpr("CAST(doc_id AS INT) AS id", "text")
    ratings = table(spark, sf, "ratings", loaded=False).join(texts, "id", "left")
    return ratings.withColumn("review_text", F.col("text")).drop("text")


@query
def extract_table(spark, sf):
    return relational.extract_table(spark, _stored(spark, sf, "viewing_sessions"), "viewing_sessions")


@query
def skip_empty(spark, sf):
    tables = {
        "users": table(spark, sf, "users"),
        "inactive_long_ago": table(spark, sf, "users").where("last_login < TIMESTAMP_NTZ '2000-01-01'"),
    }
    found = [(name, relational.skip_empty(df)) for name, df in tables.items()]
    return spark.createDataFrame(found, "name string, is_empty boolean")


@query
def land_csv_dated(spark, sf):
    root = new_folder(spark, "landing")
    path = landing.land_csv_dated(table(spark, sf, "content", loaded=False), root, "content", AS_OF)
    return joined_arrays(loading.load_csv_typed(spark, path, "content"))


@query
def land_all_tables(spark, sf):
    return landing.land_all_tables(
        spark, lambda name: table(spark, sf, name, loaded=False), new_folder(spark, "landing"), AS_OF
    )


@query
def load_csv_typed(spark, sf):
    root = new_folder(spark, "landing")
    path = landing.land_csv_dated(_with_reviews(spark, sf), root, "ratings", AS_OF)
    return loading.load_csv_typed(spark, path, "ratings")


def _typed_load(name: str) -> Query:
    def run(spark, sf):
        path = landing.land_csv_dated(
            table(spark, sf, name, loaded=False), new_folder(spark, "landing"), name, AS_OF
        )
        return joined_arrays(loading.load_csv_typed(spark, path, name))

    return run


for _name in TABLES:
    QUERIES[f"load_csv_typed_{_name}"] = _typed_load(_name)


def _damaged_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Watchlist lines, of which some have an unreadable field."""
    return table(spark, sf, "watchlist", loaded=False).select(
        F.when(F.expr("id % 7 = 0"), "x1").otherwise(F.expr("id || '.0'")).alias("id"),
        "user_id",
        "content_id",
        F.when(F.expr("id % 11 = 0"), "2024-13-45").otherwise(F.col("added_date").cast("string")).alias("added_date"),
        F.initcap(F.col("watched").cast("string")).alias("watched"),
        "watched_date",
    )


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    path = landing.land_csv_dated(_damaged_lines(spark, sf), new_folder(spark, "landing"), "watchlist", AS_OF)
    return loading.read_text(spark, path, "watchlist")


@query
def load_reject_bad_rows(spark, sf):
    good, _ = loading.load_reject_bad_rows(_damaged(spark, sf), "watchlist")
    return good


@query
def load_reject_bad_rows_rejects(spark, sf):
    _, rejects = loading.load_reject_bad_rows(_damaged(spark, sf), "watchlist")
    return rejects.select("id", "user_id", "added_date", F.array_join("bad_columns", ",").alias("bad_columns"))


@query
def load_default_loaded_at(spark, sf):
    users = table(spark, sf, "users", loaded=False).select("id", "username")
    return loading.load_default_loaded_at(users, LOADED_AT)


@query
def load_filename_pattern(spark, sf):
    root = new_folder(spark, "landing")
    for name in ("viewing_sessions", "episode_viewing"):
        landing.land_csv_dated(table(spark, sf, name, loaded=False), root, name, AS_OF)
    lines = loading.read_text(spark, f"{root}/raw/postgres/*/{AS_OF}", "viewing_sessions")
    matching = loading.load_filename_pattern(lines, r".*viewing_sessions.*\.csv")
    return loading.good_rows(matching, "viewing_sessions").select("id", "user_id", "content_id", "duration_seconds")


@query
def decode_array_columns(spark, sf):
    text = driver_table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']")).alias("tags"),
    )
    return joined_arrays(loading.decode_array_columns(text, ["tags"]))


@query
def decode_json_filters(spark, sf):
    searches = loading.decode_json_filters(table(spark, sf, "search_queries"))
    return searches.select(
        "id",
        F.col("search_filters.genre").alias("genre"),
        F.col("search_filters.year").alias("year"),
        F.col("search_filters.rating").alias("rating"),
    )


@query
def reload_day(spark, sf):
    path = new_folder(spark, "staging") + "/users"
    users = table(spark, sf, "users")
    staging_store.reload_day(users, path, LOAD_DAY)
    staging_store.reload_day(users, path, RELOAD_DAY)
    staging_store.reload_day(users.where("is_active"), path, RELOAD_DAY)  # replaces the second day only
    return spark.read.parquet(path).select("id", "username", "is_active", "_load_date")


@query
def land_incremental_query(spark, sf):
    root, out, checkpoint = (new_folder(spark, part) for part in ("landing", "loaded", "stream"))
    users = table(spark, sf, "users", loaded=False)
    landing.land_csv_dated(users, root, "users", LOAD_DAY)
    land_incremental(spark, root, "users", out, checkpoint).awaitTermination()
    landing.land_csv_dated(users.where("is_active"), root, "users", RELOAD_DAY)
    for _ in range(2):  # the second run finds nothing new
        land_incremental(spark, root, "users", out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("id", "username", "last_login", "_load_date")


QUERIES["land_incremental"] = QUERIES.pop("land_incremental_query")


@query
def landed_manifest(spark, sf):
    root = new_folder(spark, "landing")
    for name in ("users", "content"):
        # Three parts with rows each, hence three files.
        df = table(spark, sf, name, loaded=False)
        landing.land_csv_dated(df.repartitionByRange(3, "id"), root, name, AS_OF)
    files = landing.landed_manifest(spark, f"{root}/raw/postgres")
    rows = all_rows(spark, sf)
    folder = F.regexp_extract("path", r"/([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    day = F.regexp_extract("path", r"/([^/]+)/(\d{4}-\d{2}-\d{2})/[^/]+$", 2).cast("date")
    found = files.groupBy(folder.alias("table_name"), day.alias("load_date")).agg(F.count("*").alias("n_files"), F.sum("size").alias("size"))
    return found.join(rows, "table_name").select(
        "table_name", "load_date", "n_files", (F.col("size") >= F.col("least_size")).alias("big_enough")
    )


def all_rows(spark, sf):
    """Characters that landed files must hold at least: a comma per field."""
    sizes = []
    for name in ("users", "content"):
        df = table(spark, sf, name, loaded=False)
        sizes.append(df.agg(F.lit(name).alias("table_name"), (F.count("*") * len(df.columns)).alias("least_size")))
    return sizes[0].unionByName(sizes[1])


def _load_message(name: str) -> Query:
    return lambda spark, sf: messages.load_count_message(table(spark, sf, name), f"stg_{name}")


QUERIES["load_count_message"] = _load_message("users")
for _name in list(TABLES)[1:]:
    QUERIES[f"load_count_message_{_name}"] = _load_message(_name)


@query
def load_count_message_day(spark, sf):
    return messages.load_count_message_day(users_reloaded(spark, sf), "stg_users", RELOAD_DAY)


@query
def load_count_message_day_sessions(spark, sf):
    return messages.load_count_message_day(table(spark, sf, "viewing_sessions"), "stg_viewing_sessions", LOAD_DAY)


@query
def row_count_recap(spark, sf):
    return messages.row_count_recap({f"stg_{name}": df for name, df in all_tables(spark, sf).items()})


@query
def materialize(spark, sf):
    folder = new_folder(spark, "materialized")
    view = staging_store.materialize(sessions(spark, sf), "staging", "sessions_view")
    stored = staging_store.materialize(
        core.fact_viewing_sessions(spark.table(view)), "core", "sessions_table", f"{folder}/sessions_table"
    )
    return spark.table(stored).select("viewing_session_key", "user_key", "date_key", "completion_status")


@query
def run_daily_query(spark, sf):
    root, store = new_folder(spark, "landing"), new_folder(spark, "warehouse")
    landing.land_all_tables(spark, lambda name: table(spark, sf, name, loaded=False), root, AS_OF)
    landing.land_csv_dated(_damaged_lines(spark, sf), root, "watchlist", AS_OF)
    return run_daily(spark, root, store, Parameters(as_of=AS_OF))


QUERIES["run_daily"] = QUERIES.pop("run_daily_query")


# --- staging and cleaning ----------------------------------------------------


@query
def stg_users(spark, sf):
    return staging.stg_users(users_reloaded(spark, sf), AS_OF)


@query
def stg_content(spark, sf):
    return joined_arrays(catalogue(spark, sf))


@query
def stg_viewing_sessions(spark, sf):
    return sessions(spark, sf)


@query
def stg_ratings(spark, sf):
    return staging.stg_ratings(table(spark, sf, "ratings"))


@query
def stg_watchlist(spark, sf):
    return staging.stg_watchlist(table(spark, sf, "watchlist"))


@query
def stg_subscription_events(spark, sf):
    return staging.stg_subscription_events(table(spark, sf, "subscription_events"))


@query
def stg_search_queries(spark, sf):
    return staging.stg_search_queries(table(spark, sf, "search_queries"))


@query
def stg_episodes(spark, sf):
    return staging.stg_episodes(table(spark, sf, "episodes"))


@query
def stg_episode_viewing(spark, sf):
    return staging.stg_episode_viewing(table(spark, sf, "episode_viewing"))


@query
def clean_latest_per_id(spark, sf):
    users = cleaning.clean_latest_per_id(users_loaded_twice_a_day(spark, sf))
    return users.select("id", "username", "_loaded_at")


@query
def clean_delete_shared_load_ts(spark, sf):
    users = cleaning.clean_delete_shared_load_ts(users_loaded_twice_a_day(spark, sf), LOAD_DAY)
    return users.select("id", "username", "_loaded_at")


@query
def clean_invalid_duration(spark, sf):
    kept = cleaning.clean_invalid_duration(table(spark, sf, "viewing_sessions"), LOAD_DAY)
    return kept.select("id", "user_id", "duration_seconds", "_loaded_at")


# --- dimensions and facts ----------------------------------------------------


@query
def user_viewing_stats(spark, sf):
    return core.user_viewing_stats(table(spark, sf, "viewing_sessions"))


@query
def user_subscription_stats(spark, sf):
    return core.user_subscription_stats(table(spark, sf, "subscription_events"))


@query
def dim_users(spark, sf):
    return core.dim_users(
        users_reloaded(spark, sf),
        table(spark, sf, "viewing_sessions"),
        table(spark, sf, "subscription_events"),
        AS_OF,
        updated_at=AS_OF,
    )


@query
def content_viewing_stats(spark, sf):
    return core.content_viewing_stats(sessions(spark, sf))


@query
def content_rating_stats(spark, sf):
    return core.content_rating_stats(table(spark, sf, "ratings"))


@query
def dim_content(spark, sf):
    return joined_arrays(
        core.dim_content(table(spark, sf, "content"), sessions(spark, sf), table(spark, sf, "ratings"), AS_OF)
    )


@query
def dim_date(spark, sf):
    return core.dim_date(table(spark, sf, "viewing_sessions"))


@query
def dim_platform(spark, sf):
    return core.dim_platform(sessions(spark, sf))


@query
def fact_ratings(spark, sf):
    return core.fact_ratings(staging.stg_ratings(table(spark, sf, "ratings")))


@query
def fact_viewing_sessions(spark, sf):
    return core.fact_viewing_sessions(sessions(spark, sf), AS_OF)


# --- marts -------------------------------------------------------------------


@query
def content_performance_agg(spark, sf):
    return performance(spark, sf)


def _ranking(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("content_id", "total_watch_time_seconds", *columns)


@query
def watch_time_rank(spark, sf):
    return _ranking(marts.watch_time_rank(performance(spark, sf)), "watch_time_rank")


@query
def cumulative_watch_time(spark, sf):
    return _ranking(marts.cumulative_watch_time(performance(spark, sf)), "cumulative_watch_time")


@query
def total_watch_time_all(spark, sf):
    return _ranking(marts.total_watch_time_all(performance(spark, sf)), "total_watch_time_all")


@query
def watch_time_share(spark, sf):
    shares = marts.watch_time_share(marts.ranked_watch_time(performance(spark, sf)))
    return _ranking(shares, "watch_time_pct", "cumulative_watch_time_pct")


@query
def abc_class(spark, sf):
    shares = marts.watch_time_share(marts.ranked_watch_time(performance(spark, sf)))
    return _ranking(marts.abc_class(shares), "abc_class")


@query
def popularity_tier(spark, sf):
    return _ranking(marts.popularity_tier(marts.watch_time_rank(performance(spark, sf))), "popularity_tier")


@query
def content_score(spark, sf):
    return _ranking(marts.content_score(performance(spark, sf)), "content_score")


@query
def mart_content_performance(spark, sf):
    return marts.mart_content_performance(sessions(spark, sf), catalogue(spark, sf), AS_OF)


@query
def daily_engagement_agg(spark, sf):
    return marts.daily_engagement_agg(sessions(spark, sf), current_users(spark, sf))


@query
def engagement_ratios(spark, sf):
    engagement = marts.daily_engagement_agg(sessions(spark, sf), current_users(spark, sf))
    return marts.engagement_ratios(engagement).select(
        "engagement_date",
        "country_code",
        "customer_tier",
        "subscription_plan",
        "total_watch_time_hours",
        "sessions_per_user",
        "avg_session_duration_seconds",
        "web_sessions_pct",
        "mobile_sessions_pct",
        "tv_sessions_pct",
    )


@query
def mart_user_engagement(spark, sf):
    return marts.mart_user_engagement(sessions(spark, sf), current_users(spark, sf), AS_OF)


@query
def subscription_event_count(spark, sf):
    events = staging.stg_subscription_events(table(spark, sf, "subscription_events"))
    return marts.subscription_event_count(events).select("user_id", "event_type", "event_date", "event_count")


@query
def mart_subscription_analytics(spark, sf):
    events = staging.stg_subscription_events(table(spark, sf, "subscription_events"))
    return marts.mart_subscription_analytics(events, AS_OF)


# --- views and reports -------------------------------------------------------


@query
def active_users(spark, sf):
    return reports.active_users(table(spark, sf, "users", loaded=False), AS_OF)


@query
def popular_content(spark, sf):
    return reports.popular_content(
        table(spark, sf, "content"), table(spark, sf, "viewing_sessions"), table(spark, sf, "ratings")
    )


@query
def daily_engagement(spark, sf):
    return reports.daily_engagement(table(spark, sf, "viewing_sessions"))


@query
def total_users(spark, sf):
    return reports.total_users(table(spark, sf, "users"))


@query
def users_sample(spark, sf):
    return reports.users_sample(table(spark, sf, "users"))


@query
def top_content(spark, sf):
    return reports.top_content(table(spark, sf, "content"), table(spark, sf, "viewing_sessions"))


@query
def last_7_days(spark, sf):
    return reports.last_7_days(table(spark, sf, "viewing_sessions"))


@query
def verify_counts(spark, sf):
    return reports.verify_counts(all_tables(spark, sf))


@query
def verify_watch_hours(spark, sf):
    return reports.verify_watch_hours(table(spark, sf, "viewing_sessions"))


@query
def verify_avg_rating(spark, sf):
    return reports.verify_avg_rating(table(spark, sf, "ratings"))


@query
def verify_avg_completion(spark, sf):
    return reports.verify_avg_completion(table(spark, sf, "viewing_sessions"))


@query
def plan_share(spark, sf):
    return reports.plan_share(table(spark, sf, "users"))


@query
def eligible_users(spark, sf):
    return reports.eligible_users(table(spark, sf, "users"))


@query
def distinct_viewers(spark, sf):
    return reports.distinct_viewers(table(spark, sf, "viewing_sessions"))


@query
def top_rated_content(spark, sf):
    return reports.top_rated_content(table(spark, sf, "content"))


@query
def tv_show_sessions(spark, sf):
    return reports.tv_show_sessions(table(spark, sf, "viewing_sessions"), table(spark, sf, "content"))


# --- data quality ------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    return quality.dq_not_null(table(spark, sf, "users"), ["id", "email", "username", "last_login", "payment_method"])


@query
def dq_unique(spark, sf):
    return quality.dq_unique(users_reloaded(spark, sf), "email")


@query
def dq_relationships(spark, sf):
    return quality.dq_relationships(
        table(spark, sf, "viewing_sessions"), "content_id", table(spark, sf, "content"), "id"
    )


@query
def dq_unique_composite(spark, sf):
    return quality.dq_unique_composite(table(spark, sf, "ratings"), ["user_id", "content_id"])


@query
def dq_accepted_values(spark, sf):
    allowed = ["subscription_start", "upgrade", "downgrade", "renewal"]
    bad = quality.dq_accepted_values(table(spark, sf, "subscription_events"), "event_type", allowed)
    return bad.select("id", "event_type")


@query
def dq_range(spark, sf):
    return quality.dq_range(table(spark, sf, "ratings"), "rating", 2, 4).select("id", "rating")


@query
def dq_positive(spark, sf):
    return quality.dq_positive(table(spark, sf, "viewing_sessions"), "duration_seconds").select(
        "id", "duration_seconds"
    )


@query
def dq_report(spark, sf):
    raw = {**all_tables(spark, sf), "users": users_reloaded(spark, sf)}
    parameters = Parameters(as_of=AS_OF)
    stg = staging_models(raw, parameters)
    models = {**core_models(raw, stg, parameters), **mart_models(stg, parameters)}
    return quality.dq_report({**raw, **models}, as_of=AS_OF)


# --- derived columns ---------------------------------------------------------


@query
def derive_age_group(spark, sf):
    people = driver_table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "CAST(1940 + c_custkey % 80 AS INT) AS birth_year"
    )
    return derivations.derive_age_group(people, AS_OF)


@query
def derive_completion(spark, sf):
    return derivations.derive_completion(table(spark, sf, "viewing_sessions"), table(spark, sf, "content"))


@query
def classify_plan_change(spark, sf):
    events = table(spark, sf, "subscription_events").select("id", "previous_plan", "new_plan")
    return derivations.classify_plan_change(events)
