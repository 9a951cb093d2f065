"""The queries of this subpackage and, where SQL can express them on whole tables, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import cutoffs, encodings, langid, leaks, lookalikes, packing, quality, reading, repetition, scans
from docloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.wrong_labels(table(spark, d, "extracted_docs"))


def p1_languages(spark: SparkSession, d: str) -> DataFrame:
    return langid.languages(table(spark, d, "extracted_docs"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "extracted_docs")
    pages = spark.sparkContext.broadcast(scans.fit(docs))
    a = scans.noisy(docs, "ext_id", "markdown", pages).select(F.lit("extracted_docs").alias("rec_table"), F.col("ext_id").alias("rec_id"))
    b = scans.noisy(table(spark, d, "segments"), "seg_id", "content", pages).select(F.lit("segments").alias("rec_table"), F.col("seg_id").alias("rec_id"))
    return a.unionByName(b)


def p2_mended(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "extracted_docs")
    return scans.mended_records(docs, "ext_id", "markdown", spark.sparkContext.broadcast(scans.fit(docs)))


def p2_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scans.paragraphs(table(spark, d, "segments"), spark.sparkContext.broadcast(scans.fit(table(spark, d, "extracted_docs"))))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    a = lookalikes.same_looking_pairs(table(spark, d, "extracted_docs"), "ext_id", "markdown")
    b = lookalikes.same_looking_pairs(table(spark, d, "segments"), "seg_id", "content")
    return a.select(F.lit("extracted_docs").alias("rec_table"), "id_a", "id_b").unionByName(b.select(F.lit("segments").alias("rec_table"), "id_a", "id_b"))


def _both(spark: SparkSession, d: str, f) -> DataFrame:
    """Rows of an operator over extracted_docs and segments, with the table and rec_id in front."""
    rows = [(name, key, f(table(spark, d, name), key, text)) for name, key, text in (("extracted_docs", "ext_id", "markdown"), ("segments", "seg_id", "content"))]
    a, b = (df.select(F.lit(name).alias("rec_table"), F.col(key).alias("rec_id"), *(c for c in df.columns if c != key)) for name, key, df in rows)
    return a.unionByName(b)


def p3_one_form(spark: SparkSession, d: str) -> DataFrame:
    return _both(spark, d, lookalikes.normalized)


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return _both(spark, d, lookalikes.same_looking_classes)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return encodings.garbled(table(spark, d, "extracted_docs"))


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    return encodings.restored(table(spark, d, "extracted_docs"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(table(spark, d, "extracted_docs"), "ext_id", "markdown")


def p5_beyond_limits(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(table(spark, d, "extracted_docs"), "ext_id", "markdown", repetition.MOST_REPEATED)


def p5_repetition(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(table(spark, d, "extracted_docs"), "ext_id", "markdown")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.kinds(table(spark, d, "extracted_docs"), table(spark, d, "doc_results"))


def p6_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.statistics(table(spark, d, "extracted_docs"))


def p6_miscounted(spark: SparkSession, d: str) -> DataFrame:
    return quality.miscounted(table(spark, d, "extracted_docs"), table(spark, d, "doc_results"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return cutoffs.kept_results(table(spark, d, "doc_results"), table(spark, d, "keep_targets"))


def p7_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    return cutoffs.cutoffs(table(spark, d, "doc_results"), table(spark, d, "keep_targets"))


def p7_optimality(spark: SparkSession, d: str) -> DataFrame:
    return cutoffs.optimality(table(spark, d, "doc_results"), table(spark, d, "keep_targets"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(table(spark, d, "documents"), table(spark, d, "pack_bins"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(table(spark, d, "documents"), table(spark, d, "pack_bins"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_leak_report(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_levels(spark, d).select("doc_id", "reading_level")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.levels(table(spark, d, "documents"), table(spark, d, "level_samples"))


def p10_fit(spark: SparkSession, d: str) -> DataFrame:
    return reading.likelihoods(table(spark, d, "documents"), table(spark, d, "level_samples"))


_KEPT = """
WITH s AS (SELECT DISTINCT result_id, source, extract_backend, quality_score FROM doc_results
           WHERE quality_score IS NOT NULL AND quality_score::VARCHAR <> 'nan'),
t AS (SELECT source, extract_backend, greatest(0, least(100, max(keep_percent)))::INTEGER keep_percent FROM keep_targets
      WHERE keep_percent IS NOT NULL AND source IS NOT NULL AND extract_backend IS NOT NULL GROUP BY ALL),
r AS (SELECT s.*, keep_percent, count(*) OVER g n, count(*) OVER (PARTITION BY source, extract_backend ORDER BY quality_score DESC
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) at_or_above
      FROM s JOIN t USING (source, extract_backend) WINDOW g AS (PARTITION BY source, extract_backend)),
c AS (SELECT source, extract_backend, keep_percent, any_value(n) n_scored,
        max(quality_score) FILTER (WHERE 100 * at_or_above >= keep_percent * n) cutoff FROM r GROUP BY ALL)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_languages, p2_found, p2_mended, p2_paragraphs, p3_found, p3_one_form, p3_classes, p4_found, p4_restored, p5_found, p5_repetition, p5_beyond_limits, p6_found, p6_statistics, p6_miscounted, p7_found, p7_cutoffs, p7_optimality, p8_packed, p8_report, p9_found, p9_leak_report, p10_found, p10_levels, p10_fit)}


def oracle_sql() -> dict[str, str]:
    return {
        "p6_miscounted": """SELECT DISTINCT ext_id FROM extracted_docs e JOIN doc_results d ON e.sha256 = d.sha256 AND e.backend = d.extract_backend
            WHERE length(coalesce(markdown, '')) <> coalesce(markdown_chars, 0)""",
        "p7_found": _KEPT + "SELECT DISTINCT result_id FROM r JOIN c USING (source, extract_backend) WHERE quality_score >= cutoff",
        "p7_cutoffs": _KEPT + "SELECT source, extract_backend, c.keep_percent, c.n_scored, cutoff, count(*) n_kept FROM r JOIN c USING (source, extract_backend) WHERE quality_score >= cutoff GROUP BY ALL",
        "p7_optimality": _KEPT
        + """SELECT source, extract_backend, cutoff, round(sum(CASE WHEN quality_score >= cutoff THEN (100 - c.keep_percent) * (quality_score - cutoff) ELSE c.keep_percent * (cutoff - quality_score) END), 4) loss,
            (c.keep_percent * count(*) - 100 * count(*) FILTER (WHERE quality_score >= cutoff))::BIGINT slope_below, (c.keep_percent * count(*) - 100 * count(*) FILTER (WHERE quality_score > cutoff))::BIGINT slope_above
            FROM r JOIN c USING (source, extract_backend) GROUP BY source, extract_backend, cutoff, c.keep_percent""",
    }
