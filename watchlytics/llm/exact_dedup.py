"""Exact dedup by a stream over keyed state that lives on disk and never expires.

Texts are equal when they agree after white space (``\\x20 \\x09-\\x0D``) is deleted; null counts as empty. Each row enters
a ledger: the SHA-256 digest of its normalised text, its identifier ``doc_id``, its number of code points and its content
locator (file and row number). A stream reads the ledger files it has not seen and keeps per digest the preferred row so far
(most code points, then smallest identifier, then first place) and the number of rows. The state is kept by RocksDB in the
stream's checkpoint, so a later run goes on from it. Rows of a digest that has hits are then fetched and their full
normalised bytes compared with those of the kept row; should a digest ever cover different bytes, its rows are grouped by
these bytes instead.

Rows that repeat an identifier are told apart by their place, null identifiers come after all others. An empty table gives no
rows. Extra columns of any name are neither read nor in the way. Very long texts are read whole; one must fit a row.
The kept row of a repeated identifier is its first place alone; SQL without places cannot tell such rows apart.

Everything is a built-in expression. A hot text shrinks to one row per task before the state shuffle; the
joins are ones whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchlytics.llm.common import discard, placed, stored
from watchlytics.session import new_folder

#: Fixed value: the characters that do not count.
SPACES = " \t\n\x0b\x0c\r"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Setting with the number of state partitions, which a stream keeps for life. Each costs some files and 4 MB of disk whatever
#: it holds, so it follows the size of the ledger, not the session's shuffles.
PARTITIONS = "spark.sql.streaming.internal.stateStore.partitions"
LEAST_PARTITIONS = 12
PARTITION_BYTES = 128 << 20
#: Files of one micro-batch.
FILES_AT_ONCE = 1000


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Placed documents with normalised text, digest, and the order of preference as a struct."""
    bare = normalised(F.col("document.text"))
    prefer = F.struct(
        (-F.length(F.coalesce("document.text", F.lit("")))).alias("fewer"),
        F.col("document.doc_id").isNull().alias("nameless"),
        F.col("document.doc_id").alias("doc_id"),
        "file",
        "place",
    )
    return docs.select(bare.alias("bare"), digest(bare).alias("digest"), prefer.alias("row"))


def update_state(spark: SparkSession, ledger: DataFrame, checkpoint: str, files_at_once: int = FILES_AT_ONCE) -> None:
    """Feed all files of the stored ``ledger`` (digest, row) not seen before by ``checkpoint`` into its state."""
    path = ledger.stored_path
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    settings = {PROVIDER: ROCKSDB, PARTITIONS: str(max(LEAST_PARTITIONS, math.ceil(size / PARTITION_BYTES)))}
    before = {key: spark.conf.get(key, None) for key in settings}
    frame = spark.readStream.schema(ledger.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_at_once).parquet(path)
    best = frame.groupBy("digest").agg(F.min("row").alias("keep"), F.count("*").alias("n"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        query = (
            best.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as rows: digest, keep (preferred row with identifier and locator), n."""
    state = spark.read.format("statestore").load(checkpoint)
    keep, count = (f"`{c}`" for c in state.schema["value"].dataType.names)
    return state.select("key.digest", F.col(f"value.{keep}").alias("keep"), F.col(f"value.{count}").alias("n"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _calls(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the calls noted so far."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [f.getPath().toString() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]


def _moved(spark: SparkSession, old: str, new: str) -> None:
    """A folder written whole takes its place in one step, so that no reader meets a part of it."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{old} could not become {new}")


def _fetched(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` (digest, row) with the normalised text found at their locators, as digest, bare, row."""
    files = [r.file for r in rows.select("row.file").distinct().toLocalIterator()]
    kinds: dict[str, str] = {}  # files of a folder are alike: tables, or copies made by ``placed``
    texts = []
    for file in files:
        folder = file.rpartition("/")[0]
        if folder not in kinds:
            kinds[folder] = "text" if "text" in spark.read.parquet(unquote(file)).columns else "document"
    for name, schema, text in (("text", "text string", "text"), ("document", "document struct<text:string>", "document.text")):
        own = [unquote(f) for f in files if kinds[f.rpartition("/")[0]] == name]
        if own:
            read = spark.read.schema(schema).parquet(*own)
            locator = (F.col("_metadata.file_path").alias("at_file"), F.col("_metadata.row_index").alias("at_place"))
            texts.append(read.select(normalised(F.col(text)).alias("bare"), *locator))
    if not texts:
        return rows.select("digest", F.lit("").alias("bare"), "row")
    found = reduce(DataFrame.unionByName, texts)
    at = (F.col("row.file") == F.col("at_file")) & (F.col("row.place") == F.col("at_place"))
    return rows.join(found, at).select("digest", "bare", "row")


def _different_bytes(rows: DataFrame, state: DataFrame, earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Hits with their full bytes (digest, bare, row), and the digests that cover different bytes.

    Each text moves once, whatever the number of hits; a merge join's partitions can be split. Rows of ``earlier``
    calls (digest, row) that share a digest agree among themselves, unless it is known to be torn: the best is fetched, which
    the state either keeps still or has given up for a row of this call.
    """
    repeated = state.where("n > 1").select("digest", "keep")
    hits = stored(rows.join(repeated.hint("merge"), "digest").select("digest", "bare", "row", "keep"), "dedup-hits")
    first = hits.where("row = keep").select("digest", F.col("bare").alias("kept_bare"))
    compared = hits.where("row != keep").select("digest", "bare")
    if earlier is not None:
        best = earlier.groupBy("digest").agg(F.min("row").alias("row"))
        known = stored(best.join(hits.select("digest"), "digest", "left_semi"), "dedup-known")
        before = stored(_fetched(rows.sparkSession, known).join(repeated, "digest"), "dedup-before")
        first = first.unionByName(before.where("row = keep").select("digest", F.col("bare").alias("kept_bare")))
        compared = compared.unionByName(before.where("row != keep").select("digest", "bare"))
    others = compared.join(first.hint("merge"), "digest")
    # Not made distinct: that would keep the join's partitions from being split, and repeats do no harm.
    torn = stored(others.where("bare != kept_bare").select("digest"), "dedup-torn")
    return hits, torn


def duplicates(
    docs: DataFrame, checkpoint: str | None = None, digest: Callable[[Column], Column] = sha256, call: str | None = None
) -> DataFrame:
    """One row per row of ``docs`` (see ``placed``): digest, doc_id, file, place, keep_id, group_size, kept.

    With a ``checkpoint`` of its own the state outlives the call: rows of later calls meet those of earlier ones. The folder also
    keeps the rows of all calls (digest, identifier, locator) and the digests found to cover different bytes. The files of
    earlier calls must still be there: texts to compare with are fetched from them. A call that failed may be repeated with the
    same name ``call`` (letters, digits, hyphens) and the same rows of the same files: they count once.
    """
    spark = docs.sparkSession
    rows = _rows(docs, digest)
    folder = checkpoint or new_folder(spark, "dedup-state")
    noted, torn_before, earlier = f"{folder}/rows", f"{folder}/torn", None
    if not checkpoint:
        ledger = fed = stored(rows.select("digest", "row"), "dedup-ledger")
    else:  # a stream goes on only where it began, so all calls feed one folder, each from a folder of its own below
        name = call or uuid.uuid4().hex
        if not re.fullmatch("[A-Za-z0-9-]+", name):
            raise ValueError("the name of a call may have letters, digits and hyphens only")
        own, schema = f"{noted}/{name}", rows.select("digest", "row").schema
        if not _exists(spark, own):
            rows.select("digest", "row").write.mode("overwrite").parquet(f"{noted}-new/{name}")
            _moved(spark, f"{noted}-new/{name}", own)
        ledger = spark.read.schema(schema).parquet(own)
        others = [c for c in _calls(spark, noted) if c.rpartition("/")[2] != name]
        earlier = spark.read.schema(schema).parquet(*others) if others else ledger.limit(0)
        fed = ledger.limit(0)
        fed.stored_path = noted
    update_state(spark, fed, folder)
    state = stored(read_state(spark, folder), "dedup-groups")
    if not checkpoint:
        discard(spark, folder)
        hits, torn = _different_bytes(rows, state)
    else:
        hits, torn = _different_bytes(rows, state, earlier)
        torn.distinct().write.mode("append").parquet(torn_before)
        torn = stored(spark.read.schema(torn.schema).parquet(torn_before).distinct(), "dedup-torn")
    whole = ledger.join(state, "digest")
    if torn.isEmpty():
        discard(spark, hits, torn)
    else:
        parts = hits.join(torn, "digest", "left_semi").drop("keep")
        every = parts
        if earlier is not None:
            every = parts.unionByName(_fetched(spark, stored(earlier.join(torn, "digest", "left_semi"), "dedup-known")))
        by_bytes = every.groupBy("digest", "bare").agg(F.min("row").alias("keep"), F.count("*").alias("n"))
        parts = parts.join(stored(by_bytes, "dedup-parts"), ["digest", "bare"])
        whole = whole.join(torn, "digest", "left_anti").unionByName(parts.select(*whole.columns))
    return whole.select(
        "digest",
        "row.doc_id",
        "row.file",
        "row.place",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep")).alias("kept"),
    )


def unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    rows = placed(docs)
    drop = stored(duplicates(rows).where("not kept").select("file", "place"), "dedup-dropped")
    return rows.join(drop, ["file", "place"], "left_anti").select("document.*")
