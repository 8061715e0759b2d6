"""Typed loads of landed CSV files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from watchlytics.schemas import TABLES, spark_type
from watchlytics.sources.landing import OWN_FILES, observed, unescaped

BROKEN = "_broken"
FILE = "_file"

# Filters of a search as they may appear in the text column.
SEARCH_FILTERS = (
    "genre string, year int, rating string, year_range array<int>, "
    "decade string, min_rating double, content_type string"
)


def csv_options(own: bool) -> dict:
    """Reader options of landed files: those this library wrote, or all others.

    Fields of the former hold no line breaks, so their files are split between tasks. The others are
    read file by file, as any field may hold one.
    """
    return {
        "header": True,
        "quote": '"',
        "escape": '"',
        # Nothing between two commas is NULL, a pair of quotes is the empty text.
        "nullValue": "\0",
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "multiLine": not own,
        "pathGlobFilter": f"{OWN_FILES}*" if own else f"[!{OWN_FILES[0]}]*",
        "columnNameOfCorruptRecord": BROKEN,
        "columnPruning": False,
    }


def text_schema(table: str) -> str:
    """All columns as text, in file order, plus the text of lines with a wrong number of fields."""
    return ", ".join(f"{c} string" for c in [*TABLES[table], BROKEN])


def kinds_of_files(spark: SparkSession, path: str | list[str]) -> list[bool]:
    """Which files lie at the paths, by their names: own (True), foreign (False); both if there are none at all."""
    kinds = set()
    for place in [path] if isinstance(path, str) else path:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(place)
        system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(pattern) or ():
            files = system.listStatus(found.getPath()) if found.isDirectory() else [found]
            names = [f.getPath().getName() for f in files]
            kinds |= {n.startswith(OWN_FILES) for n in names if not n.startswith(("_", "."))}
    return sorted(kinds, reverse=True) or [True, False]


def _undone(lines: DataFrame, table: str) -> DataFrame:
    return lines.withColumns({c: unescaped(F.col(c)) for c, t in TABLES[table].items() if _is_text(t)})


def _is_text(declared: str) -> bool:
    return spark_type(declared) == "string" or declared.startswith("array")


def read_text(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    stream: bool = False,
    max_files: int | None = None,
    kinds: Sequence[bool] = (True, False),
) -> DataFrame:
    """Landed lines of ``table``, every field still text, with the path of their file as ``FILE``.

    Files of this library and foreign ones may lie side by side; only the ``kinds`` given (see ``kinds_of_files``) are planned for.
    """
    parts = []
    for own in kinds:
        reader = (spark.readStream if stream else spark.read).schema(text_schema(table)).options(**csv_options(own))
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        lines = reader.csv(path).withColumn(FILE, F.col("_metadata.file_path"))
        parts.append(_undone(lines, table) if own else lines)
    return reduce(DataFrame.unionByName, parts)


def load_filename_pattern(df: DataFrame, pattern: str) -> DataFrame:
    """Keep lines of files whose full path matches a regular expression.

    The path is file metadata, so the filter is applied to the list of files and files that do
    not match are never opened.
    """
    return df.where(F.col(FILE).rlike(pattern))


def _typed(column: str, declared: str) -> Column:
    """``column`` converted to its declared type, NULL where that fails."""
    text = F.col(column)
    if declared in ("int", "bigint"):
        # Exports write whole numbers as 12.0 when the column has gaps; only
        # those take the slower way through a decimal.
        return F.coalesce(text.try_cast(declared), F.round(text.try_cast("decimal(38,6)"), 0).try_cast(declared))
    if declared.startswith("array"):
        return F.from_json(text, declared)
    return text if spark_type(declared) == "string" else text.try_cast(declared)


def _bad(column: str, declared: str, typed: Column) -> Column:
    """Whether the text of a field does not fit the declared type; ``typed`` is what became of it."""
    if declared.startswith("varchar"):
        return F.char_length(column) > int(declared[8:-1])
    if declared == "string":
        return F.lit(False)
    return F.col(column).isNotNull() & typed.isNull()


def parsed(raw: DataFrame, table: str) -> DataFrame:
    """``raw`` with the typed row as struct ``_row`` and the names of columns that do not fit as ``_faults``.

    Each field is converted once; the faults follow from text and converted value.
    """
    typed = raw.withColumn("_row", F.struct(*(_typed(c, t).alias(c) for c, t in TABLES[table].items())))
    faults = [F.when(_bad(c, t, F.col(f"_row.{c}")), F.lit(c)) for c, t in TABLES[table].items()]
    return typed.withColumn("_faults", F.array_compact(F.array(*faults)))


def _fits() -> Column:
    return F.col(BROKEN).isNull() & (F.size("_faults") == 0)


def good_rows(raw: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of those lines that fit the table, with further columns to ``keep``."""
    return parsed(raw, table).where(_fits()).select("_row.*", *keep)


def rejected_rows(raw: DataFrame, table: str) -> DataFrame:
    """The other lines: their text and ``bad_columns``, the names of the columns at fault."""
    return parsed(raw, table).where(~_fits()).drop("_row").withColumnRenamed("_faults", "bad_columns")


def load_reject_bad_rows(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Split landed lines into typed rows and rejected lines.

    A line is rejected for a wrong number of fields or a field that does not
    fit its type or length; all other lines are loaded. Rejected lines keep
    their text and name the columns at fault.
    """
    return good_rows(raw, table), rejected_rows(raw, table)


class Parsed:
    """Landed lines parsed once: typed rows and rejected lines, read from what that one pass wrote.

    The lines are converted and written to ``folder`` in one job, cut by a partition column into accepted and rejected
    ones, and counted on the way. Reading either kind opens only its files, and never the landed ones again.
    """

    def __init__(self, raw: DataFrame, table: str, folder: str, keep: tuple[str, ...] = ()):
        self.folder, seen = folder, Observation()
        lines = parsed(raw, table).withColumn("_accepted", _fits())
        wide = lines.select(
            *(F.when(F.col("_accepted"), F.col(f"_row.{c}")).alias(c) for c in TABLES[table]),
            *(F.when(F.col("_accepted"), F.col(c)).alias(c) for c in keep),
            F.when(~F.col("_accepted"), F.struct(*raw.columns, F.col("_faults").alias("bad_columns"))).alias("_line"),
            "_accepted",
        )
        counted = wide.observe(seen, F.count_if("_accepted").alias("accepted"), F.count_if(~F.col("_accepted")).alias("rejected"))
        counted.write.mode("overwrite").partitionBy("_accepted").parquet(folder)
        counts = observed(seen)
        self.accepted, self.rejected = counts.get("accepted", 0), counts.get("rejected", 0)
        stored = raw.sparkSession.read.schema(wide.schema).parquet(folder)
        self.good = stored.where("_accepted").drop("_line", "_accepted")
        self.bad = stored.where("NOT _accepted").select("_line.*")


def load_csv_typed(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """Typed rows of landed files; lines that do not fit are left out."""
    return good_rows(read_text(spark, path, table, kinds=kinds_of_files(spark, path)), table)


def load_default_loaded_at(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Stamp the load time, keeping a stamp that is already there."""
    stamp = F.lit(str(as_of)).cast("timestamp_ntz")
    if "_loaded_at" in df.columns:
        stamp = F.coalesce("_loaded_at", stamp)
    return df.withColumn("_loaded_at", stamp)


def decode_array_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn text such as ``['FRA', 'USA']`` into arrays of strings."""
    return df.withColumns({c: F.from_json(c, "array<string>") for c in columns})


def decode_json_filters(df: DataFrame, column: str = "search_filters", fields: str = SEARCH_FILTERS) -> DataFrame:
    """Turn the text of search filters into a struct of the wanted ``fields``, and keep all keys.

    ``<column>_variant`` holds the whole value as VARIANT, whatever keys it has; ``column`` becomes the fields taken from
    it, each NULL where it is absent or does not fit its type. Absent and malformed filters are NULL in both. Single
    quotes are read like double ones.
    """
    whole = f"{column}_variant"
    wanted = T.StructType.fromDDL(fields).fields
    taken = [F.try_variant_get(whole, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in wanted]
    decoded = df.withColumn(whole, F.from_json(column, "variant"))
    # The text of a lone value or list is JSON too, but no filters.
    decoded = decoded.withColumn(whole, F.when(F.schema_of_variant(whole).startswith("OBJECT"), F.col(whole)))
    return decoded.withColumn(column, F.when(F.col(whole).isNotNull(), F.struct(*taken)))
