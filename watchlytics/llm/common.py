"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchlytics.session import new_folder

#: Bytes and rows of one Arrow batch handed to Python. One longer row still is one batch.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4000


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Python worker holds at a time; a smaller limit of the session stays."""
    for key, most in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
    ):
        now = spark.conf.get(key, None)
        digits = "".join(c for c in now or "" if c.isdigit() or c == "-")
        if not digits or not 0 < int(digits) <= most:
            spark.conf.set(key, str(most))


#: Folders made inside each ``released`` block that is open.
_made: list[list[str]] = []


@contextmanager
def released(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, at the end of a block, the folders that ``stored`` made inside it, but for those taken off the list given.

    Only for blocks whose results are written by then: what reads a removed folder fails.
    """
    own: list[str] = []
    _made.append(own)
    try:
        yield own
    finally:
        _made.remove(own)
        discard(spark, *own)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The rows survive lost executors, are computed once, and their size is known
    to the planner, which then broadcasts them only if they are small.
    """
    path = new_folder(df.sparkSession, purpose)
    if _made:
        _made[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_path = path
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column) -> Column:
    """Fold 0 to 3 of a row: CRC-32 of the id as text; null ids hash as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def discard(spark: SparkSession, *frames: DataFrame | str) -> None:
    """Remove the folders of stored frames, or folders by path, that nothing needs any more."""
    for frame in frames:
        path = frame if isinstance(frame, str) else frame.stored_path
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _is_plain_scan(docs: DataFrame) -> bool:
    """Whether the rows are those of files, some of them perhaps filtered out, each once."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" or node.nodeName().startswith("Relation")


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct ``document`` per row, with the row's locator: ``file`` and ``place`` within it.

    Rows read from files are located there. All others are written to the shared folder first, which gives
    every row, repeated ones too, a place that is the same whenever it is read again.
    """
    document = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")
    locator = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    if "_metadata" not in (c.lower() for c in docs.columns) and _is_plain_scan(docs):
        try:
            return docs.select(document, *locator)
        except AnalysisException:  # files without such metadata
            pass
    copy = stored(docs.select(document), "documents")
    return copy.select("document", *locator)
