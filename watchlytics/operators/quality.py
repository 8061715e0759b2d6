"""Declarative data checks. A check counts failures, it never stops a run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from watchlytics import schemas

# --- single checks -----------------------------------------------------------


def dq_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, all columns in one pass."""
    counts = (F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("failures")) for c in columns)
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; missing values are ignored."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return values.agg(F.count("*").alias("n")).where("n > 1")


def dq_unique_composite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; those with a missing part are ignored."""
    complete = df.dropna("any", subset=columns)
    return complete.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def dq_relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    Children are counted per key before the join, so a key with very many
    children costs no more than any other.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("value")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(pk).alias("_pk"))
    return keys.join(parents, F.col("value") == F.col("_pk"), "left_anti")


def dq_accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose value is not in the list; a missing value passes."""
    return df.where(~F.col(column).isin(values))


def dq_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies outside ``low`` to ``high``; a missing value passes."""
    return df.where(~F.col(column).between(low, high))


def dq_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not above 0; a missing value passes."""
    return df.where(F.col(column) <= 0)


# --- declared checks ---------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared check of a column of a model."""

    model: str
    column: str
    kind: str  # not_null, unique or relationships
    parent: str | None = None
    parent_column: str = "id"


# --- fixed values: the 55 declared checks ------------------------------------
CHECKS: list[Check] = [
    Check("users", "id", "unique"),
    Check("users", "id", "not_null"),
    Check("users", "email", "unique"),
    Check("users", "email", "not_null"),
    Check("users", "username", "unique"),
    Check("users", "username", "not_null"),
    Check("content", "id", "unique"),
    Check("content", "id", "not_null"),
    Check("content", "title", "not_null"),
    Check("viewing_sessions", "id", "unique"),
    Check("viewing_sessions", "id", "not_null"),
    Check("viewing_sessions", "user_id", "not_null"),
    Check("viewing_sessions", "user_id", "relationships", parent="users"),
    Check("viewing_sessions", "content_id", "not_null"),
    Check("viewing_sessions", "content_id", "relationships", parent="content"),
    Check("ratings", "id", "unique"),
    Check("ratings", "id", "not_null"),
    Check("ratings", "user_id", "not_null"),
    Check("ratings", "user_id", "relationships", parent="users"),
    Check("ratings", "content_id", "not_null"),
    Check("ratings", "content_id", "relationships", parent="content"),
    Check("watchlist", "id", "unique"),
    Check("watchlist", "id", "not_null"),
    Check("watchlist", "user_id", "not_null"),
    Check("watchlist", "user_id", "relationships", parent="users"),
    Check("watchlist", "content_id", "not_null"),
    Check("watchlist", "content_id", "relationships", parent="content"),
    Check("subscription_events", "id", "unique"),
    Check("subscription_events", "id", "not_null"),
    Check("subscription_events", "user_id", "not_null"),
    Check("subscription_events", "user_id", "relationships", parent="users"),
    Check("search_queries", "id", "unique"),
    Check("search_queries", "id", "not_null"),
    Check("search_queries", "user_id", "relationships", parent="users"),
    Check("search_queries", "clicked_content_id", "relationships", parent="content"),
    Check("episodes", "id", "unique"),
    Check("episodes", "id", "not_null"),
    Check("episodes", "tv_show_id", "not_null"),
    Check("episodes", "tv_show_id", "relationships", parent="content"),
    Check("episode_viewing", "id", "unique"),
    Check("episode_viewing", "id", "not_null"),
    Check("episode_viewing", "viewing_session_id", "relationships", parent="viewing_sessions"),
    Check("episode_viewing", "episode_id", "relationships", parent="episodes"),
    Check("episode_viewing", "user_id", "relationships", parent="users"),
    Check("dim_users", "user_key", "not_null"),
    Check("dim_users", "user_key", "unique"),
    Check("dim_content", "content_key", "not_null"),
    Check("dim_content", "content_key", "unique"),
    Check("mart_user_engagement", "engagement_date", "not_null"),
    Check("mart_user_engagement", "daily_active_users", "not_null"),
    Check("mart_content_performance", "content_id", "not_null"),
    Check("mart_content_performance", "watch_time_rank", "not_null"),
    Check("mart_subscription_analytics", "user_id", "not_null"),
    Check("mart_subscription_analytics", "event_type", "not_null"),
    Check("mart_subscription_analytics", "event_date", "not_null"),
]

# --- fixed values: constraints of the source tables --------------------------
UNIQUE_TOGETHER = {
    "ratings": ["user_id", "content_id"],
    "watchlist": ["user_id", "content_id"],
    "episodes": ["tv_show_id", "season_number", "episode_number"],
}
ACCEPTED_VALUES = {
    ("users", "age_group"): schemas.AGE_GROUPS,
    ("users", "subscription_plan"): schemas.SUBSCRIPTION_PLANS,
    ("content", "content_type"): schemas.CONTENT_TYPES,
    ("content", "content_rating"): schemas.CONTENT_RATINGS,
    ("viewing_sessions", "platform"): schemas.PLATFORMS,
    ("viewing_sessions", "device_type"): schemas.DEVICE_TYPES,
    ("viewing_sessions", "quality"): schemas.QUALITIES,
    ("subscription_events", "event_type"): schemas.EVENT_TYPES,
}
POSITIVE = [("content", "duration_minutes"), ("viewing_sessions", "duration_seconds")]


def value_ranges(as_of) -> dict[tuple[str, str], tuple]:
    """Allowed ranges; nothing is released after the year of ``as_of``."""
    this_year = int(str(as_of)[:4])
    return {
        ("content", "release_year"): (1900, this_year),
        ("content", "imdb_rating"): (0, 10),
        ("viewing_sessions", "completion_rate"): (0, 100),
        ("ratings", "rating"): (1, 5),
    }


# --- report ------------------------------------------------------------------


def _line(model: str, column: str, check: str) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(check).alias("check")]


@dataclass(frozen=True)
class _Key:
    """A set of key values to be looked at: whose values, of which column, compared with the values of ``domain``."""

    model: str
    column: str  # or several, separated by ", "
    check: str  # unique, unique_composite, relationships, or "" for the values of a parent only
    domain: str


def _keys(checks: Iterable[Check], tables: dict[str, DataFrame], together: bool) -> list[_Key]:
    keys = []
    for c in checks:
        if c.kind == "unique":
            keys.append(_Key(c.model, c.column, "unique", f"{c.model}.{c.column}"))
        elif c.kind == "relationships":
            keys.append(_Key(c.model, c.column, "relationships", f"{c.parent}.{c.parent_column}"))
            keys.append(_Key(c.parent, c.parent_column, "", f"{c.parent}.{c.parent_column}"))
    if together:
        for model, columns in UNIQUE_TOGETHER.items():
            if model in tables:
                name = ", ".join(columns)
                keys.append(_Key(model, name, "unique_composite", f"{model}.{name}"))
    return list(dict.fromkeys(keys))


def _is_whole(table: DataFrame, column: str) -> bool:
    return dict(table.dtypes).get(column) in ("tinyint", "smallint", "int", "bigint")


def _key_lines(tables: dict[str, DataFrame], keys: list[_Key]) -> DataFrame:
    """Failures of all checks on keys, from one pass over each table.

    Every row is stacked to its key values; these are counted inside the map tasks, so a value with very many rows
    moves as one row per task. Whole numbers travel as such and domains by number; only other keys are text.
    The counts of a value in all its roles then meet: it fails a unique check if it
    occurs more than once, and all its child rows fail if no parent has it.
    """
    domains = {domain: number for number, domain in enumerate(dict.fromkeys(k.domain for k in keys))}
    whole = {d for d in domains if all(_is_whole(tables[k.model], k.column) for k in keys if k.domain == d)}
    stacked = []
    for model in dict.fromkeys(k.model for k in keys):
        values = []
        for number, k in enumerate(keys):
            if k.model == model:
                parts = [F.col(c) for c in k.column.split(", ")]
                complete = reduce(Column.__and__, (p.isNotNull() for p in parts))
                text = parts[0].cast("string") if len(parts) == 1 else F.to_json(F.array(*(p.cast("string") for p in parts)))
                value = {"number": parts[0].cast("bigint")} if k.domain in whole else {"text": F.when(complete, text)}
                values.append(
                    F.struct(
                        F.lit(domains[k.domain]).cast("smallint").alias("domain"),
                        value.get("number", F.lit(None).cast("bigint")).alias("number"),
                        value.get("text", F.lit(None).cast("string")).alias("text"),
                        F.lit(number).cast("smallint").alias("role"),
                    )
                )
        stacked.append(tables[model].select(F.inline(F.array(*values))).where("number IS NOT NULL OR text IS NOT NULL"))
    value = ["domain", "number", "text"]
    counted = reduce(DataFrame.unionByName, stacked).groupBy(*value, "role").agg(F.count("*").alias("n"))
    parents = [number for number, k in enumerate(keys) if not k.check]
    met = counted.groupBy(*value).agg(
        F.collect_list(F.struct("role", "n")).alias("roles"), F.max(F.col("role").isin(parents)).alias("has_parent")
    )
    single = met.select("has_parent", F.inline("roles"))
    lines = []
    for number, k in enumerate(keys):
        if k.check:
            failed = F.when(~F.col("has_parent"), F.col("n")) if k.check == "relationships" else F.when(F.col("n") > 1, 1)
            failures = F.coalesce(F.sum(F.when(F.col("role") == number, failed)), F.lit(0)).cast("bigint")
            lines.append(F.struct(*_line(k.model, k.column, k.check), failures.alias("failures")))
    return single.agg(F.array(*lines).alias("counts")).select(F.inline("counts"))


def _row_rules(tables: dict[str, DataFrame], as_of) -> list[tuple[str, str, str, Column]]:
    """Constraints on single values: model, column, check, and when a row breaks it."""
    rules = []
    for (model, column), values in ACCEPTED_VALUES.items():
        rules.append((model, column, "accepted_values", ~F.col(column).isin(values)))
    for (model, column), (low, high) in value_ranges(as_of).items():
        rules.append((model, column, "range", ~F.col(column).between(low, high)))
    for model, column in POSITIVE:
        rules.append((model, column, "positive", F.col(column) <= 0))
    return [rule for rule in rules if rule[0] in tables]


def _row_rule_lines(tables: dict[str, DataFrame], rules: list[tuple[str, str, str, Column]]) -> list[DataFrame]:
    """All rules about single rows of a table, counted in one pass over it."""
    lines = []
    for model in dict.fromkeys(rule[0] for rule in rules):
        counts = (
            F.struct(*_line(model, column, check), F.count_if(broken).alias("failures"))
            for of_model, column, check, broken in rules
            if of_model == model
        )
        lines.append(tables[model].agg(F.array(*counts).alias("counts")).select(F.inline("counts")))
    return lines


def dq_report(tables: dict[str, DataFrame], checks: Iterable[Check] | None = None, as_of=None) -> DataFrame:
    """Failures of all checks on the given tables: model, column, check, failures, status.

    Each table is read twice: once for all rules about single rows, once for all its keys.

    Without ``checks`` all declared ones run whose tables are given. With
    ``as_of`` the constraints of the source tables are checked as well. A
    failure is a warning; the caller decides what follows from it.
    """
    if checks is None:
        checks = [c for c in CHECKS if c.model in tables and (c.parent is None or c.parent in tables)]
    checks = list(checks)
    keys = _keys(checks, tables, as_of is not None)
    lines = [_key_lines(tables, keys)] if keys else []
    rules = [(c.model, c.column, "not_null", F.col(c.column).isNull()) for c in checks if c.kind == "not_null"]
    if as_of is not None:
        rules += _row_rules(tables, as_of)
    lines += _row_rule_lines(tables, rules)
    status = F.when(F.col("failures") > 0, "warn").otherwise("pass").alias("status")
    return reduce(DataFrame.unionByName, lines).select("model", "column", "check", "failures", status)
