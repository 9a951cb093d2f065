"""Where documents go: guards, stage A on a probability, stage B on layout, and what comes of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.schema import COMPLEX_TYPES

#: Substrings of a creator or producer that tell scanning software.
SCANNERS = (
    "scanner", "scan", "epson", "hp scanjet", "canon", "fujitsu", "kodak", "brother", "xerox",
    "lexmark", "kmc", "kofax", "ricoh", "iris", "capturedocument", "paperport", "readiris", "simpleocr",
)


def known_scanner(*texts: Column) -> Column:
    """Whether any text names scanning software, in any case; NULL texts name none."""
    pattern = "|".join(SCANNERS)
    found = F.lit(False)
    for t in texts:
        found = found | F.coalesce(F.lower(t).rlike(pattern), F.lit(False))
    return found


def stage_a(prob: Column, threshold: float = 0.5, vlm_enabled: bool = False) -> Column:
    """Text layer below the threshold, OCR from it on (or deferred where a vision model is to take over)."""
    return F.when(prob < threshold, "mupdf").otherwise("deferred" if vlm_enabled else "pipeline")


def routed(decisions: DataFrame, threshold: float = 0.5, vlm_enabled: bool = False) -> DataFrame:
    """``decisions`` with guard and routed: the first guard that holds defers the document, else stage A decides.

    Guards in order: a router error, encryption or a needed password, no sampled page, no probability (NULL or NaN).
    """
    no_pages = F.coalesce(F.try_element_at("features", F.lit("num_pages_successfully_sampled")), F.lit(1.0)) <= 0
    unknown = F.col("ocr_prob").isNull() | F.isnan("ocr_prob")
    guard = (
        F.when(F.col("router_error").startswith("open_failed"), "open_failed")
        .when(F.coalesce("is_encrypted", F.lit(False)) | F.coalesce("needs_password", F.lit(False)), "encrypted")
        .when(no_pages, "no_pages")
        .when(F.col("router_error").isNotNull() | unknown, "classify_failed")
    )
    return decisions.withColumn("guard", guard).withColumn("routed", F.when(F.col("guard").isNotNull(), "deferred").otherwise(stage_a(F.col("ocr_prob"), threshold, vlm_enabled)))


def needs_ocr(backend: Column) -> Column:
    """Whether anything but the text layer is asked for; false for NULL."""
    return F.coalesce(backend != "mupdf", F.lit(False))


def stage_b(has_complex: Column, vlm_enabled: bool = False) -> Column:
    """Backend by content: tables and formulas want the vision model, which may be off."""
    return F.when(has_complex, "vlm" if vlm_enabled else "deferred").otherwise("pipeline")


def stage_b_rows(segments: DataFrame, vlm_enabled: bool = False) -> DataFrame:
    """Per document (sha256, backend): num_pages, num_regions, num_complex_regions, has_complex_content, stage_b."""
    hard = F.col("seg_type").isin(*COMPLEX_TYPES)
    return (
        segments.groupBy("sha256", "backend")
        .agg(F.count_distinct("page_index").alias("num_pages"), F.count("*").alias("num_regions"), F.count_if(hard).alias("num_complex_regions"))
        .withColumn("has_complex_content", F.col("num_complex_regions") > 0)
        .withColumn("stage_b", stage_b(F.col("has_complex_content"), vlm_enabled))
    )


def stage_b_cached(documents: DataFrame, layouts: DataFrame, vlm_enabled: bool = False) -> DataFrame:
    """``documents`` with the decision of their cached layout, NULL where none is cached; one layout a key is used, the greatest model tag."""
    best = layouts.groupBy("sha256").agg(F.max_by("pages", "layout_model").alias("pages"))
    hard = F.exists(F.flatten(F.transform("pages", lambda p: p["regions"])), lambda r: r["type"].isin(*COMPLEX_TYPES))
    decided = best.select("sha256", F.coalesce(hard, F.lit(False)).alias("has_complex_content")).withColumn("stage_b", stage_b(F.col("has_complex_content"), vlm_enabled))
    return documents.join(decided, "sha256", "left")


def effective_backend(stage_b_backend: Column, backend: Column) -> Column:
    return F.coalesce(stage_b_backend, backend)


def lane(backend: Column, has_layout: Column) -> Column:
    """Parser that a document runs through; 'skip' where its layout is missing or it is deferred."""
    return F.when(backend.isNull() | (backend == "mupdf"), "text").when((backend == "pipeline") & has_layout, "ocr").when((backend == "vlm") & has_layout, "vlm").otherwise("skip")


def first_error(*errors: Column, most: int = 500) -> Column:
    """The first error text in stage order, cut; later ones are dropped."""
    return F.substring(F.coalesce(*errors), 1, most)


def kept(error_class: Column, score: Column, threshold: float = 2.0) -> Column:
    """No error and a score at or above the threshold; NULL and NaN scores are not kept."""
    return F.coalesce(error_class.isNull() & (score >= threshold) & ~F.isnan(score), F.lit(False))


def published_markdown(markdown: Column, include: bool = True) -> Column:
    """Markdown for the result table: NULL if left out or empty; a single line feed is not empty."""
    return F.nullif(markdown, F.lit("")) if include else F.lit(None).cast("string")


def wall_total(*parts: Column) -> Column:
    total = F.lit(0.0)
    for p in parts:
        total = total + F.coalesce(p, F.lit(0.0))
    return total


def short_text(markdown_chars: Column, expected_chars: Column, share: float = 0.3) -> Column:
    """Whether a text layer gave so little of what was expected that OCR should read the document."""
    return F.coalesce(markdown_chars < expected_chars * share, F.lit(False))
