"""Staging tables on disk and publishing of models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from watchlytics.sources.landing import exists, observed, remove

#: Folder name of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def day_path(path: str, as_of: dt.date | str) -> str:
    """Partition folder of one load day."""
    return f"{path.rstrip('/')}/_load_date={as_of}"


def reload_day(df: DataFrame, path: str, as_of: dt.date | str) -> None:
    """Replace one load day of a staging table; other days stay untouched.

    Writing the day's own partition also clears it when ``df`` is empty, which
    a dynamic overwrite would not.
    """
    df.drop("_load_date").write.mode("overwrite").parquet(day_path(path, as_of))


def materialize(
    df: DataFrame,
    layer: str,
    name: str,
    path: str | None = None,
    partition_by: str | None = None,
    changed: list | None = None,
) -> str:
    """Publish a model under ``<layer>_<name>``: staging as view, the rest as table.

    ``path`` stores the table outside the catalog's own folder. ``partition_by`` cuts it into one folder per value;
    rows are dealt to tasks by it first, spread evenly by Spark where a value holds many, so that folders get few files.

    With ``changed``, the values whose rows may differ from those stored, only their folders are written
    anew, or removed where ``df`` has no such row any more; no other row of ``df`` is computed and no other file
    touched. This needs ``path`` and ``partition_by``; where nothing is stored yet the whole table is written.
    """
    published = f"{layer}_{name}"
    if layer == "staging":
        df.createOrReplaceTempView(published)
        return published
    spark = df.sparkSession
    if changed is not None and exists(spark, path):
        replace_folders(df, path, partition_by, changed)
        if not spark.catalog.tableExists(published) or not _lies_at(spark, published, path):
            spark.sql(f"DROP TABLE IF EXISTS {published}")  # the files of an external table stay
            spark.catalog.createTable(published, path, "parquet")
        if spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true":  # the catalog keeps a list of folders
            spark.sql(f"MSCK REPAIR TABLE {published} SYNC PARTITIONS")
        spark.catalog.refreshTable(published)
        return published
    writer = df.hint("rebalance", partition_by).write if partition_by else df.write
    writer = writer.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(published)
    return published


def _lies_at(spark: SparkSession, table: str, path: str) -> bool:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    place = spark._jvm.org.apache.hadoop.fs.Path
    whole = place(path).getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place(path))
    return described is not None and place(described.data_type).equals(whole)


def replace_folders(df: DataFrame, path: str, column: str, values: list) -> None:
    """Write the rows of ``df`` with these values of ``column`` in place of their folders; other folders stay as they are."""
    if not values:
        return
    spark = df.sparkSession
    known = [v for v in values if v is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    rows = df.where(wanted | F.col(column).isNull() if None in values else wanted)
    written = Observation()
    rows = rows.observe(written, F.collect_set(F.col(column).cast("string")).alias("values"), F.count_if(F.col(column).isNull()).alias("nulls"))
    writer = rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)
    found = observed(written)
    for value in values:
        there = found.get("nulls", 0) > 0 if value is None else str(value) in found.get("values", ())
        if not there:
            remove(spark, f"{path.rstrip('/')}/{column}={NO_VALUE if value is None else value}")
