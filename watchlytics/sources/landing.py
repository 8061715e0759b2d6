"""Landing table snapshots as dated CSV folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from watchlytics.schemas import TABLES
from watchlytics.sources.relational import skip_empty

# Bounds the size of a landed file for readers that cannot split it.
ROWS_PER_FILE = 1_000_000

# Names of files written here begin so: their fields hold no raw line breaks, hence tasks may split them.
OWN_FILES = "+lines"


def landing_path(root: str, table: str, as_of: dt.date | str) -> str:
    """Folder of one table and day."""
    return f"{root.rstrip('/')}/raw/postgres/{table}/{as_of}"


def escaped(text: Column) -> Column:
    """Text without line breaks: backslash, line feed and carriage return become two characters each."""
    for character, name in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(character), F.lit(name))
    return text


def unescaped(text: Column) -> Column:
    """The text that :func:`escaped` was given."""
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "\\")).otherwise(text)


def _as_text(df: DataFrame) -> DataFrame:
    # CSV has no arrays: they are landed as JSON text. The CSV writer would cut
    # timestamps to milliseconds, a cast keeps all digits.
    arrays = {c: escaped(F.to_json(c)) for c, t in df.dtypes if t.startswith("array")}
    stamps = {c: F.col(c).cast("string") for c, t in df.dtypes if t.startswith("timestamp")}
    texts = {c: escaped(F.col(c)) for c, t in df.dtypes if t == "string"}
    return df.withColumns({**arrays, **stamps, **texts})


def land_csv_dated(df: DataFrame, root: str, table: str, as_of: dt.date | str) -> str:
    """Write a snapshot with header lines; a second run replaces the day.

    Line breaks are escaped and the files carry a name of their own, so a load knows that it
    may split them and has to undo the escapes.
    """
    path = landing_path(root, table, as_of)
    (
        _as_text(df)
        .write.mode("overwrite")
        .options(
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            maxRecordsPerFile=ROWS_PER_FILE,
        )
        .option("mapreduce.output.basename", OWN_FILES)
        .csv(path)
    )
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, without listing what it holds."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def observed(seen: Observation) -> dict:
    """What was observed while a frame was written; nothing where Spark knew it to be empty and ran no task."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def make(spark: SparkSession, path: str) -> None:
    """Make a folder, if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def land_all_tables(
    spark: SparkSession, tables: Callable[[str], DataFrame], root: str, as_of: dt.date | str
) -> DataFrame:
    """Land the nine tables; returns rows written per table, 0 for a skipped one.

    The counts are observed while the files are written, not in a second pass.
    """
    counts = []
    for name in TABLES:
        df = tables(name)
        written = 0
        if skip_empty(df):
            remove(spark, landing_path(root, name, as_of))  # left by an earlier run of the day
        else:
            seen = Observation(f"land_{name}")
            land_csv_dated(df.observe(seen, F.count(F.lit(1)).alias("n")), root, name, as_of)
            written = observed(seen).get("n", 0)
        counts.append((name, written))
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def landed_manifest(spark: SparkSession, path: str, names: str = "*.csv") -> DataFrame:
    """Landed files below ``path``: path, size and modification time.

    Only the listing is used, the files are not opened.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=names).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
