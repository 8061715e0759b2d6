"""The daily run: load, clean, build all models, check them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from watchlytics.operators.cleaning import clean_invalid_duration, clean_latest_per_id
from watchlytics.operators.messages import row_count_recap
from watchlytics.operators.quality import dq_report
from watchlytics.plans.changes import ChangedDays
from watchlytics.plans.models import PARTITIONS, Parameters, application_views, core_models, mart_models, staging_models
from watchlytics.schemas import TABLES, ddl
from watchlytics.session import new_folder
from watchlytics.sources.landing import exists, landing_path, observed, remove
from watchlytics.sources.loading import Parsed, kinds_of_files, load_default_loaded_at, read_text
from watchlytics.sources.staging_store import day_path, materialize, reload_day

#: Tables loaded, and models written, at the same time: small ones leave tasks free.
TABLES_AT_ONCE = 4


def load_table(spark: SparkSession, landing: str, store: str, rejected: str, table: str, as_of: str) -> tuple[int, int]:
    """Load and clean the landed files of one table and day; returns rows loaded and lines rejected.

    The files are parsed once; typed rows and rejected lines are cut from what that pass wrote.
    Cleaning touches only the day that is loaded, so it happens on the way in:
    the day is written once and never rewritten. What an earlier run of the day left of a table that is
    empty now goes.
    """
    path = landing_path(landing, table, as_of)
    if not exists(spark, path):  # nothing was landed for an empty table
        remove(spark, day_path(f"{store}/{table}", as_of))
        remove(spark, day_path(f"{rejected}/{table}", as_of))
        return 0, 0
    both = Parsed(read_text(spark, path, table, kinds=kinds_of_files(spark, path)), table, new_folder(spark, f"parsed-{table}"))
    if both.rejected:
        reload_day(both.bad, f"{rejected}/{table}", as_of)
    else:
        remove(spark, day_path(f"{rejected}/{table}", as_of))
    rows = load_default_loaded_at(both.good, as_of)
    if table == "users":
        rows = clean_latest_per_id(rows)
    if table == "viewing_sessions":
        rows = clean_invalid_duration(rows, as_of)
    loaded = Observation()
    reload_day(rows.observe(loaded, F.count(F.lit(1)).alias("n")), f"{store}/{table}", as_of)
    remove(spark, both.folder)
    return observed(loaded).get("n", 0), both.rejected


def load_day(spark: SparkSession, landing: str, store: str, rejected: str, as_of: str) -> dict[str, tuple[int, int]]:
    """Load all tables of one day, several at a time; returns rows loaded and lines rejected per table."""
    load = inheritable_thread_target(spark)(lambda table: load_table(spark, landing, store, rejected, table, as_of))
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return dict(zip(TABLES, pool.map(load, TABLES)))


def read_store(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """The nine staging tables with all their load days."""
    tables = {}
    for table in TABLES:
        schema = f"{ddl(table)}, _loaded_at timestamp_ntz, _load_date date"
        path = f"{store}/{table}"
        known = exists(spark, path)
        tables[table] = spark.read.schema(schema).parquet(path) if known else spark.createDataFrame([], schema)
    return tables


def _loads(spark: SparkSession, counts: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows loaded and lines rejected on the day, per source table, as counted while they were written."""
    lines = [(kind, table, "", n) for table, both in counts.items() for kind, n in zip(("loaded", "rejects"), both)]
    return spark.createDataFrame(lines, "kind string, name string, check string, n bigint")


def run_daily(spark: SparkSession, landing: str, store: str, parameters: Parameters) -> DataFrame:
    """Run one day; returns what was built and what the checks found.

    The report has one row per object: kind, name, check and number. Kinds are ``loaded`` and
    ``rejects`` (rows loaded and lines left out on the day, per source table), ``rows`` and ``check``.
    Rejected lines are kept in ``<store>/rejects/<table>/_load_date=<day>``. Failed checks are reported, not raised.
    The application views are published as ``app_<name>``. The session fact and the engagement mart, which are stored by
    day, are computed and written only for days that this run changes (see ``ChangedDays``); rows of other days keep the
    ``updated_at`` of the run that wrote them.
    """
    days = ChangedDays(spark, store, parameters)
    days.note_sessions()
    counts = load_day(spark, landing, f"{store}/staging", f"{store}/rejects", parameters.as_of)
    days.note_sessions()
    raw = read_store(spark, f"{store}/staging")
    stg = staging_models(raw, parameters)
    for name, df in stg.items():
        materialize(df, "staging", name)
    for name, df in application_views(raw, parameters).items():
        df.createOrReplaceTempView(f"app_{name}")

    changed = days.found(stg)
    jobs = [("core", *model) for model in core_models(raw, stg, parameters).items()]
    jobs += [("marts", *model) for model in mart_models(stg, parameters).items()]

    def publish(job: tuple[str, str, DataFrame]) -> str:
        layer, name, df = job
        return materialize(df, layer, name, f"{store}/{layer}/{name}", PARTITIONS.get(name), changed.get(name))

    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        published = list(pool.map(inheritable_thread_target(spark)(publish), jobs))
    built = {name: spark.table(table) for (_, name, _), table in zip(jobs, published)}
    days.settle(stg)

    rows = row_count_recap({**stg, **built}).select(
        F.lit("rows").alias("kind"), F.col("table_name").alias("name"), F.lit("").alias("check"), F.col("row_count").alias("n")
    )
    checks = dq_report({**raw, **built}, as_of=parameters.as_of).select(
        F.lit("check").alias("kind"), F.concat_ws(".", "model", "column").alias("name"), "check", F.col("failures").alias("n")
    )
    return reduce(DataFrame.unionByName, [_loads(spark, counts), rows, checks])
