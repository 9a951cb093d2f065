"""The whole run as one plan: each stage adds columns to a row per document and never drops or throws for bad data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.config import RunConfig
from docloom.functions import text
from docloom.operators import routing
from docloom.schema import COMPLEX_TYPES, RESULT_TABLE

#: A provider turns the documents of its lane into scores or texts; columns in, a column out.
Provider = Callable[[DataFrame], Column]


def rule_quality(markdown: Column, most: int = 10_000) -> Column:
    """A rule-based score in [0, 3] of the text's first characters: long words and ended sentences raise it; blank text scores 0."""
    t = F.substring(text.strip(F.coalesce(markdown, F.lit(""))), 1, most)
    words = F.regexp_count(t, F.lit(r"[\p{L}\p{N}]+"))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    ends = F.regexp_count(t, F.lit(r"[.!?。？！]"))
    score = 1.5 * text.clamp(text.safe_ratio(letters, F.length(t)), 0.0, 1.0) + 1.5 * text.clamp(text.safe_ratio(ends * 12, words), 0.0, 1.0)
    return F.when(t == "", 0.0).otherwise(F.round(text.clamp(score, 0.0, 3.0), 4))


def parsed(segments: DataFrame) -> DataFrame:
    """(sha256, segs): all segments of a document once, by backend and index; they meet in the one shuffle that merging them needs."""
    item = F.struct("backend", "seg_index", "page_index", "seg_type", "content", "bbox")
    return segments.where("sha256 IS NOT NULL").groupBy("sha256").agg(F.array_sort(F.array_distinct(F.collect_list(item))).alias("segs"))


def run(decisions: DataFrame, segments: DataFrame, config: RunConfig | None = None, quality: Callable[[Column], Column] = rule_quality) -> DataFrame:
    """The result table of a run over router decisions and segments (as a parser gives them).

    Documents are the distinct paths of ``decisions``. Each of the router, layout, extract and quality stages runs if the
    configuration has it; after an error the later ones are skipped and the first error stays. Segments are read and
    shuffled once; markdown, failures and excerpt all come from the segments that a document's lane extracts, its layout
    from one extraction (the pipeline's, else the vision model's), so a PDF extracted twice counts once. A plan has no
    time of its own for a stage: wall_ms_total is NULL.
    """
    config = config or RunConfig()
    has = set(config.stages)
    docs = decisions.groupBy("pdf_path").agg(F.max_by(F.struct(*(c for c in decisions.columns if c != "pdf_path")), F.struct("decided_at", "sha256")).alias("d")).select("pdf_path", "d.*")
    rows = routing.routed(docs, config.router.ocr_threshold, config.router.vlm_enabled).withColumn("error_router", F.when(F.col("guard").isNotNull(), F.coalesce("router_error", F.col("guard"))))
    rows = rows.drop("backend").withColumnRenamed("routed", "backend")
    if "layout" in has or "extract" in has:
        rows = rows.join(parsed(segments), "sha256", "left")
    by = lambda name: F.filter("segs", lambda s: s["backend"] == name)
    hard = lambda s: F.coalesce(s["seg_type"].isin(*COMPLEX_TYPES), F.lit(False))
    if "layout" in has:
        rows = rows.withColumn("laid", F.when(F.size(by("pipeline")) > 0, by("pipeline")).when(F.size(by("vlm")) > 0, by("vlm")))
        placed = routing.needs_ocr(F.col("backend")) & F.col("error_router").isNull() & F.col("laid").isNotNull()
        rows = rows.withColumn("layout_num_regions", F.when(F.col("laid").isNotNull(), F.size("laid"))).withColumn("layout_has_complex", F.exists("laid", hard))
        rows = rows.withColumn("stage_b_backend", F.when(placed, routing.stage_b(F.col("layout_has_complex"), config.vlm.enabled))).withColumn("layout_model", F.when(placed, config.layout.model)).drop("laid")
    else:
        rows = rows.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("layout_num_regions", "int"), ("layout_has_complex", "boolean"), ("stage_b_backend", "string"), ("layout_model", "string"))))
    rows = rows.withColumn("extract_backend", routing.effective_backend(F.col("stage_b_backend"), F.col("backend")))
    if "extract" in has:
        runs = (routing.lane(F.col("extract_backend"), F.col("layout_num_regions").isNotNull()) != "skip") & F.col("error_router").isNull()
        rows = rows.withColumn("own", F.when(runs, F.filter("segs", lambda s: s["backend"] == F.col("extract_backend"))))
        rows = rows.withColumn("error_extract", F.when(runs & (F.coalesce(F.size("own"), F.lit(0)) <= 0), "no segments"))
        if not config.vlm.include_simple_pages:
            pages = F.transform(F.filter("own", hard), lambda s: s["page_index"])
            rows = rows.withColumn("own", F.when(F.col("extract_backend") == "vlm", F.filter("own", lambda s: F.array_contains(pages, s["page_index"]))).otherwise(F.col("own")))
        body = lambda s: text.strip(F.coalesce(s["content"], F.lit("")))
        merged = text.merge_markdown(F.transform("own", body))
        rows = rows.withColumn("markdown", F.when(F.col("error_extract").isNull() & F.col("own").isNotNull(), merged))
        rows = rows.withColumn("region_failures", F.when(F.col("error_extract").isNull() & F.col("own").isNotNull(), F.size(F.filter("own", lambda s: body(s) == ""))))
        shown = F.transform("own", lambda s: F.struct(s["page_index"].alias("page_index"), s["seg_type"].alias("type"), F.when(s["bbox"].isNotNull(), F.array(*(s["bbox"][k] for k in ("x0", "y0", "x1", "y1")))).alias("bbox"), F.substring(F.coalesce(s["content"], F.lit("")), 1, 200).alias("content")))
        rows = rows.withColumn("segments_excerpt", F.when(F.col("extract_backend") == "vlm", text.excerpt_json(shown)))
    else:
        rows = rows.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("markdown", "string"), ("region_failures", "int"), ("segments_excerpt", "string"), ("error_extract", "string"))))
    scored = "quality" in has and config.quality.enabled
    score = F.when(F.col("markdown").isNotNull() & (F.col("markdown") != ""), quality(F.col("markdown"))) if scored else F.lit(None).cast("double")
    rows = rows.withColumn("quality_score", score).withColumn("quality_model", F.when(F.col("quality_score").isNotNull(), config.quality.model))
    rows = rows.withColumn("error_message", routing.first_error(F.col("error_router"), F.col("error_extract")))
    rows = rows.withColumn("error_class", F.when(F.col("error_router").isNotNull(), "router").when(F.col("error_extract").isNotNull(), F.concat(F.lit("extract_"), F.col("extract_backend"))))
    rows = rows.withColumn("markdown_chars", F.coalesce(F.length("markdown"), F.lit(0)).cast("bigint"))
    publish = config.publish
    made = rows.withColumn("kept", routing.kept(F.col("error_class"), F.col("quality_score"), publish.quality_threshold))
    made = made.withColumn("markdown", routing.published_markdown(F.col("markdown"), publish.include_markdown)).withColumn("wall_ms_total", F.lit(None).cast("double")).withColumn("ocr_prob", text.known(F.col("ocr_prob")))
    return made.select(*(F.col(n).cast(t).alias(n) for n, t in RESULT_TABLE))
