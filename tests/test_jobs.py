"""Incremental landing and the daily run."""

import datetime as dt

import pytest
from conftest import rows
from frames import frame, session, title, user

from pyspark.sql import functions as F

from watchlytics import schemas
from watchlytics.__main__ import main
from watchlytics.plans.daily import run_daily
from watchlytics.plans.models import Parameters
from watchlytics.sources import landing
from watchlytics.sources.loading import read_text
from watchlytics.streaming.incremental import land_incremental, store_batch


def test_each_file_is_loaded_once(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / part) for part in ("landing", "out", "checkpoint"))
    users = frame(spark, "users", *(user(i) for i in range(40))).drop("_loaded_at")

    def run():
        land_incremental(spark, root, "users", out, checkpoint, max_files=1).awaitTermination()
        return rows(spark.read.parquet(out).groupBy("_load_date").count())

    landing.land_csv_dated(users.repartition(3), root, "users", "2024-01-01")
    assert run() == [(dt.date(2024, 1, 1), 40)]
    assert run() == [(dt.date(2024, 1, 1), 40)]
    landing.land_csv_dated(users.where("id < 5"), root, "users", "2024-01-02")
    assert run() == [(dt.date(2024, 1, 1), 40), (dt.date(2024, 1, 2), 5)]


def test_one_stream_fills_both_sinks(spark, tmp_path):
    """Good and rejected lines of each batch; a batch that is repeated replaces its own rows in either place."""
    folder = tmp_path / "raw" / "postgres" / "watchlist" / "2024-01-01"
    folder.mkdir(parents=True)
    for k in range(3):
        (folder / f"part{k}.csv").write_text(f"id,user_id,content_id,added_date,watched,watched_date\n{k},2,3,,True,\nx{k},2,3,,,\n")
    out, bad, checkpoint = (str(tmp_path / part) for part in ("out", "bad", "checkpoint"))

    def found():
        return rows(spark.read.parquet(out), "id", "_load_date"), rows(spark.read.parquet(bad), "id", "bad_columns")

    def run():
        land_incremental(spark, str(tmp_path), "watchlist", out, checkpoint, max_files=1, rejects=bad).awaitTermination()
        return found()

    day = dt.date(2024, 1, 1)
    want = [(k, day) for k in range(3)], [(f"x{k}", ["id"]) for k in range(3)]
    assert run() == want == run()
    batches = {r[0] for r in rows(spark.read.parquet(out), "_batch")}
    assert len(batches) >= 3
    lines = read_text(spark, str(folder / "part1.csv"), "watchlist").withColumn("_load_date", F.lit(day))
    again = next(r._batch for r in spark.read.parquet(out).where("id = 1").collect())
    for _ in range(2):
        store_batch(lines, again, "watchlist", out, bad, str(tmp_path / "work"))
        assert found() == want


def test_a_folder_of_a_file_sink_is_refused(spark, tmp_path):
    (tmp_path / "out" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError):
        land_incremental(spark, str(tmp_path), "users", str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_bad_lines_do_not_stop_the_stream(spark, tmp_path):
    folder = tmp_path / "raw" / "postgres" / "watchlist" / "2024-01-01"
    folder.mkdir(parents=True)
    (folder / "watchlist_20240101.csv").write_text("id,user_id,content_id,added_date,watched,watched_date\n1.0,2,3,,True,\nx,2,3,,,\n")
    out = str(tmp_path / "out")
    land_incremental(spark, str(tmp_path), "watchlist", out, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(out), "id", "watched") == [(1, True)]


def test_daily_run_twice(spark, tmp_path):
    tables = {name: frame(spark, name).drop("_loaded_at") for name in schemas.TABLES}
    tables["users"] = frame(spark, "users", user(1), user(1), user(2)).drop("_loaded_at")
    tables["content"] = frame(spark, "content", title(1), title(2)).drop("_loaded_at")
    tables["viewing_sessions"] = frame(
        spark, "viewing_sessions", session(1), session(2, 2), session(3, 9), session(4, seconds=0)
    ).drop("_loaded_at")
    root, store = str(tmp_path / "landing"), str(tmp_path / "store")
    reports = []
    for as_of in ("2024-02-01", "2024-02-01", "2024-02-02"):
        landing.land_all_tables(spark, tables.__getitem__, root, as_of)
        report = run_daily(spark, root, store, Parameters(as_of=as_of))
        reports.append({(r.kind, r.name, r.check): r.n for r in report.collect()})
    first, again, next_day = reports
    assert first == again
    assert first["rows", "stg_users", ""] == 2 and first["rows", "dim_users", ""] == 2
    assert first["rows", "stg_viewing_sessions", ""] == 3 and first["rows", "fact_viewing_sessions", ""] == 3
    assert first["rows", "stg_ratings", ""] == 0 and first["rows", "mart_subscription_analytics", ""] == 0
    assert first["check", "viewing_sessions.user_id", "relationships"] == 1
    assert first["check", "users.id", "unique"] == 0
    # The next day adds its own snapshot: users are current in staging, the dimension shows each load.
    assert next_day["rows", "stg_users", ""] == 2 and next_day["rows", "dim_users", ""] == 4
    assert next_day["check", "users.id", "unique"] == 2
    assert next_day["loaded", "users", ""] == 2 and next_day["rejects", "users", ""] == 0
    assert {row.id for row in spark.table("app_active_users").collect()} <= {1, 2}
    assert spark.table("app_daily_engagement").count() > 0 and spark.table("app_popular_content").count() == 0


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    tables = {name: frame(spark, name).drop("_loaded_at") for name in schemas.TABLES}
    root, store = str(tmp_path / "landing"), str(tmp_path / "store")
    folder = tmp_path / "landing" / "raw" / "postgres" / "watchlist" / "2024-02-01"
    landing.land_all_tables(spark, tables.__getitem__, root, "2024-02-01")
    folder.mkdir(parents=True)
    (folder / "export.csv").write_text("id,user_id,content_id,added_date,watched,watched_date\n1,2,3,,True,\nx,2,3,,,\n4,5\n")
    for _ in range(2):
        report = {(r.kind, r.name): r.n for r in run_daily(spark, root, store, Parameters(as_of="2024-02-01")).collect()}
        assert report["loaded", "watchlist"] == 1 and report["rejects", "watchlist"] == 2
    kept = spark.read.parquet(f"{store}/rejects/watchlist")
    assert {(r.id, tuple(r.bad_columns)) for r in kept.collect()} == {("x", ("id",)), ("4", ())}
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    job = ["load", "--landing", root, "--table", "watchlist", "--out", out, "--checkpoint", str(tmp_path / "checkpoint")]
    main([*job, "--rejects", bad])
    assert spark.read.parquet(out).count() == 1 and spark.read.parquet(bad).count() == 2


def test_a_table_that_became_empty_leaves_nothing_of_its_day(spark, tmp_path):
    empty = {name: frame(spark, name).drop("_loaded_at") for name in schemas.TABLES}
    full = empty | {"users": frame(spark, "users", user(1)).drop("_loaded_at")}
    root, store = str(tmp_path / "landing"), str(tmp_path / "store")
    counts = []
    for tables in (full, empty):
        landing.land_all_tables(spark, tables.__getitem__, root, "2024-02-01")
        report = {(r.kind, r.name): r.n for r in run_daily(spark, root, store, Parameters(as_of="2024-02-01")).collect()}
        counts.append((report["loaded", "users"], report["rows", "stg_users"]))
    assert counts == [(1, 1), (0, 0)]


def test_command_line(spark, tmp_path, capsys):
    source, landing_root, store = tmp_path / "source", str(tmp_path / "landing"), str(tmp_path / "store")
    for name in schemas.TABLES:
        df = frame(spark, name, user(1)) if name == "users" else frame(spark, name)
        df.drop("_loaded_at").write.parquet(str(source / name))
    day = ["--landing", landing_root, "--as-of", "2024-02-01"]
    main(["extract", "--source-format", "parquet", "--source-root", str(source), *day])
    main(["daily", "--store", store, *day])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    main(["load", "--landing", landing_root, "--table", "users", "--out", out, "--checkpoint", checkpoint])
    assert spark.read.parquet(f"{store}/core/dim_users").count() == 1
    assert spark.read.parquet(out).count() == 1
    assert "mart_user_engagement" in capsys.readouterr().out
