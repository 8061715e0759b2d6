"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchlytics.llm import (
    arc_warc,
    bpe,
    decontamination,
    exact_dedup,
    fill_middle,
    html_template,
    language,
    piece_bpe,
    quality,
    simhash,
    spelling,
    token_counts,
    url_filter,
)
from watchlytics.llm.common import fold_of, placed, stored, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(placed(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs.withColumn("lengths", token_counts.line_sections(F.col("text"))), "lengths")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = arc_warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judged(decontamination.find_benchmark_spans(docs, table(spark, sf_dir, "benchmark")))
    items = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    featured = stored(quality.features(docs), "quality-features")
    model = quality.train(featured, table(spark, sf_dir, "labels"))
    scored = quality.score(featured, model)
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fps = stored(simhash.fingerprints(docs).select("doc_id", "fp"), "simhash")
    found = simhash.near_duplicates(fps, "doc_id")
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold_of(F.col("doc_id")) == 2
    model = language.learn(docs.where(~held_out))
    found = language.label_spans(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op8_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_template.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op11_sentencepiece_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest_documents(table(spark, sf_dir, "documents"))


def op12_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, slip=spelling.SLIP).select("word", "form", "root", "n", "n_near", "form_n")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_token_counts,
        op3_warc,
        op4_benchmark_decontamination,
        op5_quality_classifier,
        op6_simhash_near_dedup,
        op7_language_id,
        op8_bpe_encoding_and_decoding,
        op9_html_extraction,
        op10_url_filters,
        op11_sentencepiece_encoding_and_decoding,
        op12_spelling_variant_grouping,
        op13_fill_in_middle,
    )
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        WITH bare AS (
            SELECT doc_id,
                   length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER best AS kept,
               text_sha256
        FROM bare
        WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
    """,
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id,
                   strlen(coalesce(html, '')) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        best AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> response THEN response END AS refers_to
        FROM best
    """,
    "op13_fill_in_middle": """
        WITH given AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
            FROM documents
        ),
        numbers AS (
            SELECT *, ('0x' || hex[1:8])::BIGINT % (n + 1) AS a, ('0x' || hex[9:16])::BIGINT % (n + 1) AS b,
                   ('0x' || hex[17:24])::BIGINT % 100 AS c, ('0x' || hex[25:32])::BIGINT % 100 AS d
            FROM given
        ),
        cuts AS (
            SELECT *, least(a, b) AS p, greatest(a, b) AS q,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
                        WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM numbers
        ),
        parts AS (
            SELECT *, substring(text, 1, p) AS prefix, substring(text, p + 1, q - p) AS middle, substring(text, q + 1, n - q) AS suffix
            FROM cuts
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
}
