"""Checks on deliberately dirty rows."""

import pytest
from conftest import rows
from frames import frame, session, title, user

from watchlytics.operators import quality


@pytest.fixture(scope="module")
def dirty(spark):
    return {
        "users": frame(
            spark,
            "users",
            user(1, age_group="18-24", subscription_plan="basic"),
            user(1, age_group="12", subscription_plan=None),
            user(None, subscription_plan="gold"),
            dict(id=3, email=None, username="u1"),
        ),
        "content": frame(
            spark,
            "content",
            title(1, release_year=1899, imdb_rating="10.0"),
            title(2, release_year=2025, duration_minutes=0, content_rating="X"),
            title(3, title=None, content_type="clip", release_year=2024),
        ),
        "viewing_sessions": frame(
            spark,
            "viewing_sessions",
            session(1, 1, 1, rate="100.00", platform="web"),
            session(2, 9, 1, rate="100.01", platform="radio"),
            session(3, 9, None, rate="-0.01", seconds=0),
            session(4, None, 8, rate=None, seconds=-1),
        ),
        "ratings": frame(
            spark,
            "ratings",
            *(dict(id=i, user_id=u, content_id=1, rating=r) for i, (u, r) in enumerate([(1, 0), (1, 6), (None, 5), (None, 1)])),
        ),
    }


def test_single_checks(dirty):
    users, sessions = dirty["users"], dirty["viewing_sessions"]
    assert rows(quality.dq_not_null(users, ["id", "email", "country"])) == [("country", 1), ("email", 1), ("id", 1)]
    assert rows(quality.dq_unique(users, "id")) == [(1, 2)]
    assert rows(quality.dq_relationships(sessions, "user_id", users, "id")) == [(9, 2)]
    assert rows(quality.dq_relationships(sessions, "content_id", dirty["content"], "id")) == [(8, 1)]
    assert rows(quality.dq_unique_composite(dirty["ratings"], ["user_id", "content_id"])) == [(1, 1, 2)]
    assert rows(quality.dq_accepted_values(sessions, "platform", ["web"]), "id") == [(2,)]
    assert rows(quality.dq_range(sessions, "completion_rate", 0, 100), "id") == [(2,), (3,)]
    assert rows(quality.dq_positive(sessions, "duration_seconds"), "id") == [(3,), (4,)]


def test_report(dirty):
    report = {(r.model, r.column, r.check): (r.failures, r.status) for r in quality.dq_report(dirty, as_of="2024-02-01").collect()}
    assert report[("users", "id", "unique")] == (1, "warn")
    assert report[("users", "id", "not_null")] == (1, "warn")
    assert report[("users", "username", "unique")] == (1, "warn")
    assert report[("users", "email", "not_null")] == (1, "warn")
    assert report[("users", "age_group", "accepted_values")] == (1, "warn")
    assert report[("users", "subscription_plan", "accepted_values")] == (1, "warn")
    assert report[("content", "release_year", "range")] == (2, "warn")
    assert report[("content", "imdb_rating", "range")] == (0, "pass")
    assert report[("content", "content_type", "accepted_values")] == (1, "warn")
    assert report[("content", "content_rating", "accepted_values")] == (1, "warn")
    assert report[("content", "duration_minutes", "positive")] == (1, "warn")
    assert report[("content", "title", "not_null")] == (1, "warn")
    assert report[("viewing_sessions", "id", "unique")] == (0, "pass")
    assert report[("viewing_sessions", "user_id", "relationships")] == (2, "warn")
    assert report[("viewing_sessions", "platform", "accepted_values")] == (1, "warn")
    assert report[("viewing_sessions", "completion_rate", "range")] == (2, "warn")
    assert report[("viewing_sessions", "duration_seconds", "positive")] == (2, "warn")
    assert report[("ratings", "rating", "range")] == (2, "warn")
    assert report[("ratings", "user_id, content_id", "unique_composite")] == (1, "warn")
    assert not any(model == "watchlist" for model, _, _ in report)


def test_declared_checks():
    kinds = [c.kind for c in quality.CHECKS]
    assert (len(kinds), kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships")) == (55, 13, 29, 13)


def test_whole_numbers_travel_as_numbers(spark, dirty):
    """Keys of one whole number move as such; composite and text keys as text; the report is that of text keys alone."""
    report = rows(quality.dq_report(dirty))
    as_text = quality._is_whole
    quality._is_whole = lambda table, column: False
    try:
        assert rows(quality.dq_report(dirty)) == report
    finally:
        quality._is_whole = as_text
    assert quality._is_whole(dirty["users"], "id") and not quality._is_whole(dirty["users"], "email")


def test_numbers_of_different_width_meet(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id bigint")
    child = spark.createDataFrame([(1, 1), (2, 3), (3, None)], "id int, parent int")
    checks = [
        quality.Check("child", "parent", "relationships", parent="parent", parent_column="id"),
        quality.Check("parent", "id", "unique"),
        quality.Check("child", "id", "unique"),
    ]
    found = quality.dq_report({"parent": parent, "child": child}, checks)
    assert rows(found, "model", "check", "failures") == [("child", "relationships", 1), ("child", "unique", 0), ("parent", "unique", 1)]
