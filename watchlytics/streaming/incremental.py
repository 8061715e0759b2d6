"""Load files as they arrive, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from watchlytics.session import new_folder
from watchlytics.sources.landing import exists, make, remove
from watchlytics.sources.loading import FILE, Parsed, read_text, rejected_rows


def _lines(spark: SparkSession, root: str, table: str, max_files: int | None) -> DataFrame:
    path = f"{root.rstrip('/')}/raw/postgres/{table}/*"
    lines = read_text(spark, path, table, stream=True, max_files=max_files)
    return lines.withColumn("_load_date", F.regexp_extract(FILE, r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1).cast("date"))


def _start(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .partitionBy("_load_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def store_batch(lines: DataFrame, batch: int, table: str, out: str, rejects: str | None, work: str) -> None:
    """Parse the lines of a batch once; write typed rows and, if asked for, rejected lines, both under its number.

    The folders of a batch are replaced as a whole, so a batch that is repeated after a failure leaves
    its lines once in either place.
    """
    spark = lines.sparkSession
    both = Parsed(lines, table, f"{work}/batch-{batch}", keep=("_load_date",))
    rows = both.good.withColumn("_loaded_at", F.col("_load_date").cast("timestamp_ntz"))
    for found, folder in ((rows, out), (both.bad, rejects)):
        if folder:
            numbered = found.withColumn("_batch", F.lit(batch))
            writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("_load_date", "_batch").parquet(folder)
    remove(spark, both.folder)


def land_incremental(
    spark: SparkSession,
    root: str,
    table: str,
    out: str,
    checkpoint: str,
    max_files: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Load all files of ``table`` not loaded before, then stop.

    The load day comes from the dated folder of a file and is its load time, so the result can
    serve as a staging table. Lines that do not fit go to ``rejects``, if given, with the columns at fault and their
    file; one stream fills both, and every file is opened once. Both are cut into folders by load day and
    by the number of the batch (``_batch``). The stream's checkpoint
    remembers files, so a second run without new files adds nothing; a day that
    is landed again counts as new files. Use it for folders that only grow, and
    ``reload_day`` for days that may be replaced.
    ``max_files`` limits one batch, not the run: all files are still loaded.
    """
    for folder in (out, rejects):
        if folder and exists(spark, f"{folder}/_spark_metadata"):
            raise ValueError(f"{folder} was filled by a file sink, whose log hides all other files")
        if folder:
            make(spark, folder)
    work = new_folder(spark, f"incremental-{table}")
    return (
        _lines(spark, root, table, max_files)
        .writeStream.foreachBatch(lambda lines, batch: store_batch(lines, batch, table, out, rejects, work))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reject_incremental(
    spark: SparkSession, root: str, table: str, out: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Keep the lines that a ``land_incremental`` without ``rejects`` leaves out, with the columns at fault and their file.

    A stream of its own with its own checkpoint, for files that were loaded before anyone asked for their rejects.
    """
    return _start(rejected_rows(_lines(spark, root, table, max_files), table), out, checkpoint)
