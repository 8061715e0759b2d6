"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Each stage works on all documents its predecessor kept. Its result is written as Parquet to the shared
folder and read again by the next stage, so lost executors cost no more than the stage at hand.

Null texts count as empty in every stage, very long ones are read whole, repeated rows and ties are settled as the operators
say, an empty table gives an empty result, and other columns, whatever their names, stay with their documents until the
last stage, which returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchlytics.llm import bpe, decontamination, exact_dedup, quality, simhash
from watchlytics.llm.common import discard, free_name, released, stored, table


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier takes for quality, learnt from the labelled ones among ``docs``."""
    score = free_name(docs, "quality_score")
    model = quality.train_texts(docs, table(spark, sf_dir, "labels"))
    return quality.score_texts(docs, model, score).where(F.col(score) >= quality.THRESHOLD).select(*_columns(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The preferred document of each group of equal texts."""
    return exact_dedup.unique(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash.near_unique(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by benchmark passages, whole."""
    packed = docs.select(F.struct(*_columns(docs)).alias("document"), "text")
    found = decontamination.find_benchmark_spans(packed, table(spark, sf_dir, "benchmark"))
    return decontamination.judged(found).where("not contaminated").select("document.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents left, with digests of ids and of the text decoded from them."""
    return bpe.digest_documents(docs, with_ids=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("bpe encoding and decoding", tokenise),
]

#: No SQL: classifier, fingerprints and BPE cannot be expressed in it; the tests hold brute-force versions against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with released(spark) as made:  # what a stage wrote on its way goes when its result is written
            docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
            made.remove(docs.stored_path)
        if before:
            discard(spark, before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
