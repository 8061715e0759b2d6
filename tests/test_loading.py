"""Landing and loading, with damaged and awkward files."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Row, functions as F

from watchlytics import schemas
from watchlytics.sources import landing, loading, relational, staging_store
from watchlytics.streaming.incremental import land_incremental, reject_incremental

AS_OF = "2024-02-01"

MESSY_CONTENT = '''id,title,content_type,genre,subgenre,release_year,duration_minutes,director,main_actor,imdb_rating,content_rating,is_original,added_date,available_countries,tags,description
1,Plain,movie,Drama,,2001.0,90,,,7.25,PG,True,2024-01-01,"['FRA', 'USA']","[""a"", ""b c""]",One line
2,"Said ""no"", twice",tv_show,Comedy,,,45.0,,,,,False,,[],,"Two
lines, one field"
3,Bad year,movie,Drama,,20x1,90,,,,,,,,,
4,Bad date,movie,Drama,,,90,,,,,,2024-13-45,,,
5,Bad array,movie,Drama,,,90,,,,,,,"['FRA', ",,
6,Too few fields,movie
7,Bad type name that is longer than allowed,a type name of more than twenty letters,Drama,,,90,,,,,,,,,
8,Bad number,movie,Drama,,,90,,,123.4,,,,,,
9,,movie,"",,,90,,,,,,,,,"  kept blanks "
'''


def write(tmp_path, text):
    path = tmp_path / "content_20240201.csv"
    path.write_text(text)
    return str(path)


def test_messy_file(spark, tmp_path):
    raw = loading.read_text(spark, write(tmp_path, MESSY_CONTENT), "content")
    good, rejects = loading.load_reject_bad_rows(raw, "content")
    found = {r.id: r for r in good.collect()}
    assert sorted(found) == [1, 2, 9]
    assert found[1].available_countries == ["FRA", "USA"] and found[1].tags == ["a", "b c"]
    assert found[1].release_year == 2001 and found[1].imdb_rating == Decimal("7.3")
    assert found[1].is_original is True and found[1].added_date == dt.date(2024, 1, 1)
    assert found[2].title == 'Said "no", twice' and found[2].description == "Two\nlines, one field"
    assert found[2].duration_minutes == 45 and found[2].release_year is None and found[2].is_original is False
    assert found[9].title is None and found[9].genre == "" and found[9].description == "  kept blanks "
    reasons = {r.id: r.bad_columns for r in rejects.select("id", "bad_columns").collect()}
    assert reasons == {
        "3": ["release_year"],
        "4": ["added_date"],
        "5": ["available_countries"],
        "6": [],
        "7": ["content_type"],
        "8": ["imdb_rating"],
    }


def test_counts_do_not_depend_on_selected_columns(spark, tmp_path):
    typed = loading.load_csv_typed(spark, write(tmp_path, MESSY_CONTENT), "content")
    assert typed.count() == 3
    assert typed.select("description").count() == 3
    assert len(typed.select("id").collect()) == 3


@pytest.mark.parametrize("table", list(schemas.TABLES))
def test_empty_file_has_the_declared_schema(spark, tmp_path, table):
    path = tmp_path / "x.csv"
    path.write_text(",".join(schemas.TABLES[table]) + "\n")
    typed = loading.load_csv_typed(spark, str(path), table)
    assert typed.count() == 0
    assert dict(typed.dtypes) == {c: schemas.spark_type(t) for c, t in schemas.TABLES[table].items()}


def test_round_trip_keeps_every_value(spark, tmp_path):
    data = [
        Row(1, 2, 3, 4, dt.datetime(2024, 1, 1, 2, 3, 4, 123456), 'a "quoted", text\r\nand\n\nmore', None),
        Row(2, 2, 3, 5, dt.datetime(2024, 1, 1), "", 0),
        Row(3, 2, 3, 5, None, None, 7),
        Row(4, 2, 3, 5, None, "  blanks\tand \\ back\\slashes \\\" ", 7),
        Row(5, 2, 3, 5, None, '"', 7),
    ]
    df = spark.createDataFrame(data, schemas.ddl("ratings"))
    path = landing.land_csv_dated(df, str(tmp_path), "ratings", AS_OF)
    assert path.endswith("/raw/postgres/ratings/2024-02-01")
    assert rows(loading.load_csv_typed(spark, path, "ratings")) == rows(df)


def test_landing_again_replaces_the_day(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3, None, True, None)], schemas.ddl("watchlist"))
    for _ in range(2):
        path = landing.land_csv_dated(df, str(tmp_path), "watchlist", AS_OF)
    assert loading.load_csv_typed(spark, path, "watchlist").count() == 1


def test_empty_tables_are_skipped(spark, tmp_path):
    def tables(name):
        empty = spark.createDataFrame([], schemas.ddl(name))
        return empty.unionByName(spark.createDataFrame([(1, 2, 3, None, True, None)], schemas.ddl(name))) if (
            name == "watchlist"
        ) else empty

    counts = dict(rows(landing.land_all_tables(spark, tables, str(tmp_path), AS_OF)))
    assert counts == {name: int(name == "watchlist") for name in schemas.TABLES}
    assert {p.name for p in (tmp_path / "raw" / "postgres").iterdir()} == {"watchlist"}
    assert landing.landed_manifest(spark, str(tmp_path)).where("size > 0").count() > 0


def test_file_name_pattern(spark, tmp_path):
    for name in ("viewing_sessions_20240201.csv", "viewing_sessions.bak", "other.csv"):
        (tmp_path / name).write_text("h\n1,2,3,2024-01-01 00:00:00,,5,web,tv,,,,,,\n")
    lines = loading.read_text(spark, str(tmp_path), "viewing_sessions")
    assert lines.count() == 3
    matching = loading.load_filename_pattern(lines, r".*viewing_sessions.*\.csv")
    assert matching.count() == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = matching.select("id")._jdf.queryExecution().executedPlan()
        executed.executeCollect()
        leaves = executed.collectLeaves()
        opened = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
        assert sorted(opened) == [0, 1]  # no file of this library, one foreign file
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_loaded_at_keeps_existing_stamps(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None)], "id int, _loaded_at timestamp_ntz")
    stamped = loading.load_default_loaded_at(df, "2024-02-01 02:00:00")
    assert rows(stamped) == [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1, 2))]


def test_decoding(spark):
    df = spark.createDataFrame(
        [(1, "['a', 'b']", "{'genre': 'Action', 'year_range': [1990, 2000]}"), (2, None, None), (3, "[]", '{"min_rating": 6.5}')],
        "id int, tags string, search_filters string",
    )
    decoded = loading.decode_json_filters(loading.decode_array_columns(df, ["tags"]))
    found = {r.id: r for r in decoded.collect()}
    assert [found[i].tags for i in (1, 2, 3)] == [["a", "b"], None, []]
    assert found[1].search_filters.genre == "Action" and found[1].search_filters.year_range == [1990, 2000]
    assert found[2].search_filters is None and found[3].search_filters.min_rating == 6.5


def test_filters_keep_keys_nobody_asked_for(spark):
    texts = ["{'genre': 'A', 'own key': {'a': [1, 2]}}", '{"year": "soon", "decade": "90s"}', "{broken", "[1]", "7", "null", "", None, "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, search_filters string")
    found = loading.decode_json_filters(df).selectExpr(
        "id", "search_filters.genre", "search_filters.year", "search_filters.decade", "search_filters IS NULL AS none",
        "to_json(search_filters_variant) AS whole", "try_variant_get(search_filters_variant, \"$['own key'].a[1]\", 'int') AS own",
    )
    assert rows(found) == sorted([
        (0, "A", None, None, False, '{"genre":"A","own key":{"a":[1,2]}}', 2),
        (1, None, None, "90s", False, '{"decade":"90s","year":"soon"}', None),
        *((i, None, None, None, True, None, None) for i in range(2, 8)),
        (8, None, None, None, False, "{}", None),
    ], key=repr)


def test_reload_day_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "users")
    df = spark.range(3)
    staging_store.reload_day(df, path, "2024-01-01")
    staging_store.reload_day(df, path, "2024-01-02")
    staging_store.reload_day(df.where("id = 1"), path, "2024-01-02")
    per_day = rows(spark.read.parquet(path).groupBy("_load_date").count())
    assert per_day == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 1)]
    staging_store.reload_day(df.limit(0), path, "2024-01-01")
    assert rows(spark.read.parquet(path).groupBy("_load_date").count()) == [(dt.date(2024, 1, 2), 1)]


def test_jdbc_options():
    options = relational.jdbc_options({"url": "jdbc:x", "fetchsize": "500"}, "users", "id", (1, 99), 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"], options["fetchsize"]) == ("1", "100", "500")


def test_parquet_source(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "users"))
    assert relational.extract_table(spark, {"format": "parquet", "root": str(tmp_path)}, "users").count() == 5
    assert relational.skip_empty(spark.range(0)) and not relational.skip_empty(spark.range(1))


def test_materialize(spark):
    view = staging_store.materialize(spark.range(3), "staging", "some_view")
    assert spark.table(view).count() == 3
    for n in (4, 2):
        table = staging_store.materialize(spark.range(n), "core", "some_table")
        assert spark.table(table).count() == n


NASTY = ["a\nb", "a\r\nb", "\r", "\n", 'say "no"', "back\\slash", "\\n", "\\\n", "\\\\r\\", "a,b\\"]


def nasty_rows(spark, table):
    """Ten rows with line breaks, quotes and backslashes in every text column."""
    data = []
    for i, text in enumerate(NASTY):
        row = []
        for declared in schemas.TABLES[table].values():
            kind = schemas.spark_type(declared)
            if kind == "string":
                row.append(text[: int(declared[8:-1])] if declared.startswith("varchar") else text)
            elif kind.startswith("array"):
                row.append([text, "x"])
            else:
                row.append(i if kind in ("int", "bigint") else None)
        data.append(tuple(row))
    return spark.createDataFrame(data, schemas.ddl(table))


@pytest.mark.parametrize("table", list(schemas.TABLES))
def test_line_breaks_survive_the_round_trip(spark, tmp_path, table):
    df = nasty_rows(spark, table)
    path = landing.land_csv_dated(df.repartition(2), str(tmp_path), table, AS_OF)
    good, rejects = loading.load_reject_bad_rows(loading.read_text(spark, path, table), table)
    assert rejects.count() == 0
    assert rows(good) == rows(df)


@pytest.mark.parametrize("table", list(schemas.TABLES))
def test_line_breaks_survive_the_stream(spark, tmp_path, table):
    df = nasty_rows(spark, table)
    landing.land_csv_dated(df, str(tmp_path / "landing"), table, AS_OF)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    land_incremental(spark, str(tmp_path / "landing"), table, out, str(tmp_path / "c1")).awaitTermination()
    reject_incremental(spark, str(tmp_path / "landing"), table, bad, str(tmp_path / "c2")).awaitTermination()
    loaded = spark.read.parquet(out)
    assert rows(loaded, *df.columns) == rows(df)
    assert loaded.select("_loaded_at").distinct().collect() == [Row(dt.datetime(2024, 2, 1))]
    assert spark.read.schema("_broken string").parquet(bad).count() == 0


@pytest.mark.parametrize("table", list(schemas.TABLES))
def test_foreign_files_may_break_lines_in_any_column(spark, tmp_path, table):
    df = nasty_rows(spark, table)
    arrays = [c for c, t in df.dtypes if t.startswith("array")]
    texts = df.withColumns({c: F.to_json(c) for c in arrays}).toPandas()
    texts.to_csv(tmp_path / "export.csv", index=False)
    good, rejects = loading.load_reject_bad_rows(loading.read_text(spark, str(tmp_path), table), table)
    assert rejects.count() == 0
    assert good.count() == len(NASTY)


def test_own_and_foreign_files_side_by_side(spark, tmp_path):
    path = landing.land_csv_dated(nasty_rows(spark, "users"), str(tmp_path), "users", AS_OF)
    foreign = "\n".join([",".join(schemas.TABLES["users"]), '77,a\\nb,"two' + "\n" + 'lines"' + "," * (len(schemas.TABLES["users"]) - 3)])
    with open(f"{path}/export.csv", "w") as file:
        file.write(foreign + "\n")
    found = loading.load_csv_typed(spark, path, "users")
    assert found.count() == len(NASTY) + 1
    assert rows(found.where("id = 77"), "email", "username") == [("a\\nb", "two\nlines")]


def test_own_files_are_split(spark, tmp_path):
    """Files written here are cut between tasks, so their size does not matter."""
    plain = spark.createDataFrame([(i, 2, 3, None, True, None) for i in range(5000)], schemas.ddl("watchlist"))
    path = landing.land_csv_dated(
        nasty_rows(spark, "watchlist").unionByName(plain).coalesce(1), str(tmp_path), "watchlist", AS_OF
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = loading.load_csv_typed(spark, path, "watchlist")
        assert found.rdd.getNumPartitions() > 3
        assert found.count() == 5000 + len(NASTY)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
