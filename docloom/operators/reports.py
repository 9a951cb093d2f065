"""Summaries, distributions and listings over the table of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text
from docloom.operators import routing
from docloom.schema import BACKENDS, RESULT_TABLE


def distinct_results(results: DataFrame) -> DataFrame:
    """Each ``result_id`` once; rows delivered twice are unchanged."""
    return results.dropDuplicates(["result_id"])


def result_table(results: DataFrame, documents: DataFrame | None = None, threshold: float = 2.0, include_markdown: bool = True) -> DataFrame:
    """The published table of ``RESULT_TABLE``, one row per result, with markdown from ``documents`` (sha256, backend, markdown)."""
    rows = distinct_results(results)
    if documents is None:
        rows = rows.withColumn("markdown", F.lit(None).cast("string"))
    else:
        texts = documents.groupBy("sha256", F.col("backend").alias("extract_backend")).agg(F.max("markdown").alias("markdown"))
        rows = rows.join(texts, ["sha256", "extract_backend"], "left")
    made = {
        "markdown": routing.published_markdown(F.col("markdown"), include_markdown),
        "ocr_prob": text.known(F.col("ocr_prob")),
        "markdown_chars": F.coalesce("markdown_chars", F.lit(0)),
        "error_message": F.substring("error_message", 1, 500),
        "kept": routing.kept(F.col("error_class"), F.col("quality_score"), threshold),
        "wall_ms_total": routing.wall_total(*(F.col(f"wall_ms_{s}") for s in ("router", "layout", "extract", "quality"))),
    }
    return rows.select(*(made.get(n, F.col(n)).cast(t).alias(n) for n, t in RESULT_TABLE))


def run_summary(results: DataFrame) -> DataFrame:
    """One row: totals, errors, kept, scores; counts by backend and stage B as sorted JSON maps."""
    rows = distinct_results(results)
    score = F.when(~F.isnan("quality_score"), F.col("quality_score"))
    return rows.agg(
        F.count("*").alias("num_pdfs"),
        F.count_if(F.col("error_class").isNull() & F.col("sha256").isNotNull()).alias("num_extracted"),
        F.count_if(F.col("error_class").isNull() & (F.col("markdown_chars") > 0)).alias("num_with_markdown"),
        F.count(score).alias("num_scored"),
        F.count("error_class").alias("num_errors"),
        F.count_if(routing.kept(F.col("error_class"), F.col("quality_score"))).alias("num_kept"),
        F.round(F.sum(score.cast("decimal(38,10)")), 6).cast("double").alias("sum_quality"),
        F.round((F.sum(score.cast("decimal(38,10)")) / F.count(score)).cast("double"), 6).alias("avg_quality"),
        *(_counts_map(c).alias(n) for c, n in ((F.when(F.col("backend").isNotNull(), F.coalesce("extract_backend", "backend")), "by_backend"), (F.col("stage_b_backend"), "by_stage_b"))),
    )


def _counts_map(value: Column) -> Column:
    """Counts of the few values of a column of backends as a JSON object sorted by value, in the same aggregation; NULLs don't count."""
    known = F.array(*(F.struct(F.lit(b).alias("k"), F.count_if(value == b).alias("n")) for b in sorted(BACKENDS)))
    some = F.filter(known, lambda x: x["n"] > 0)
    return F.concat(F.lit("{"), F.array_join(F.transform(some, lambda x: F.concat(F.lit('"'), x["k"], F.lit('":'), x["n"].cast("string"))), ","), F.lit("}"))


def bench_summary(results: DataFrame) -> DataFrame:
    """One row of a benchmark loop: documents, errors of router or extraction, scored ones and the counts by final backend."""
    rows = distinct_results(results)
    failed = F.col("router_error").isNotNull() | F.coalesce(F.col("error_class").startswith("extract"), F.lit(False))
    return rows.agg(F.count("*").alias("num_pdfs"), F.count_if(failed).alias("num_errors"), F.count_if(F.col("quality_score").isNotNull() & ~F.isnan("quality_score")).alias("num_scored"), _counts_map(routing.effective_backend(F.col("stage_b_backend"), F.col("backend"))).alias("by_backend"))


def counts_by(results: DataFrame, column: Column, name: str, skip_null: bool = False) -> DataFrame:
    rows = distinct_results(results).withColumn(name, column)
    return (rows.where(F.col(name).isNotNull()) if skip_null else rows).groupBy(name).agg(F.count("*").alias("n"))


def distributions(results: DataFrame) -> DataFrame:
    """(dimension, value, n) of extract backend ('NULL' for none), stage B, source and error class in one pass; NULLs of the others are left out."""
    rows = distinct_results(results).select(F.coalesce("extract_backend", F.lit("NULL")).alias("backend"), F.col("stage_b_backend").alias("stage_b"), text.path_source(F.col("pdf_path")).alias("source"), F.col("error_class").alias("error"))
    pairs = F.array(*(F.struct(F.lit(n).alias("dimension"), F.col(n).alias("value")) for n in rows.columns))
    return rows.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def histogram(rows: DataFrame, column: str, low: float, high: float, bins: int = 20) -> DataFrame:
    """(bin, edge, n) of equal bins, empty ones too; values below or above count in the first or last, NULL and NaN in none; no values, no rows."""
    v = rows.where(F.col(column).isNotNull() & ~F.isnan(column)).select(F.greatest(F.lit(0), F.least(F.lit(bins - 1), ((F.col(column) - low) / (high - low) * bins).cast("int"))).alias("bin"))
    counts = v.groupBy("bin").agg(F.count("*").alias("n"))
    dense = counts.agg(F.sum("n").alias("total")).where("total > 0").select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return dense.join(counts, "bin", "left").select("bin", F.round(F.lit(low) + (high - low) * F.col("bin") / bins, 6).alias("edge"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def percentiles(rows: DataFrame, column: str) -> DataFrame:
    """One row min, p25, p50, p75, max by position n * k // 4 of the sorted values, without interpolation; zeros for none.

    Works on the counts of distinct values: the position is found by a running total, not by sorting rows into one task.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("v")).agg(F.count("*").alias("c"))
    # running totals in two steps: within hash-free ranges of values, then over the few ranges
    ranged = counts.withColumn("r", F.floor(F.col("v") / 1024))
    within = F.sum("c").over(Window.partitionBy("r").orderBy("v"))
    ranges = ranged.groupBy("r").agg(F.sum("c").alias("rc"))
    before = ranges.select("r", (F.sum("rc").over(Window.orderBy("r")) - F.col("rc")).alias("before"), F.sum("rc").over(Window.partitionBy()).alias("n"))
    at = ranged.withColumn("w", within).join(before, "r").select("v", "n", (F.col("before") + F.col("w")).alias("upto"))
    pick = lambda k: F.coalesce(F.min(F.when(F.col("upto") > F.floor(F.col("n") * k / 4), F.col("v"))), F.lit(0)).cast("bigint")
    return at.agg(F.coalesce(F.min("v"), F.lit(0)).cast("bigint").alias("min"), pick(1).alias("p25"), pick(2).alias("p50"), pick(3).alias("p75"), F.coalesce(F.max("v"), F.lit(0)).cast("bigint").alias("max"))


def view_rows(results: DataFrame) -> DataFrame:
    """Rows of a listing: short ids, file names, sets, preview keys, defaults for what is missing."""
    sha = F.coalesce("sha256", F.lit(""))
    name = F.when(F.coalesce(F.col("pdf_path"), F.lit("")) != "", text.basename(F.col("pdf_path"))).otherwise("unknown.pdf")
    return distinct_results(results).select(
        "result_id",
        F.when(sha != "", F.substring(sha, 1, 8)).otherwise(F.format_string("r%03d", F.col("result_id"))).alias("id"),
        name.alias("pdf_basename"),
        text.path_source(F.col("pdf_path")).alias("path_source"),
        text.preview_key(F.col("pdf_path")).alias("preview_key"),
        F.coalesce("num_pages", F.lit(0)).alias("num_pages"),
        F.coalesce("is_form", F.lit(False)).alias("is_form"),
        F.coalesce("markdown_chars", F.lit(0).cast("bigint")).alias("markdown_chars"),
        text.known(F.col("ocr_prob")).alias("ocr_prob"),
        routing.kept(F.col("error_class"), F.col("quality_score")).alias("kept"),
    )


def dashboard(results: DataFrame, flagged: DataFrame | None = None, *, bad_only: bool = False, kept_only: bool = False, errors_only: bool = False, backend: str = "", source: str = "", search: str = "") -> DataFrame:
    """Results that pass all filters (empty ones pass all), best quality first, unscored last, ties by id.

    ``flagged`` (sha256) are the active bad cases; the search is a part of the file name in any case.
    """
    rows = distinct_results(results)
    if bad_only and flagged is not None:
        rows = rows.join(flagged.select("sha256").distinct(), "sha256", "left_semi")
    if kept_only:
        rows = rows.where(routing.kept(F.col("error_class"), F.col("quality_score")))
    if errors_only:
        rows = rows.where("error_class IS NOT NULL")
    if backend:
        rows = rows.where(F.col("extract_backend") == backend)
    if source:
        rows = rows.where(F.col("source") == source)
    if search:
        rows = rows.where(F.lower(text.basename(F.col("pdf_path"))).contains(search.lower()))
    score = F.coalesce(F.when(~F.isnan("quality_score"), F.col("quality_score")), F.lit(-1.0))
    return rows.withColumn("sort_score", score).orderBy(F.desc("sort_score"), F.lower(F.coalesce("extract_backend", F.lit(""))), "result_id")


def run_diff(before: DataFrame, after: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(pdf_path, change) of documents whose backend or probability differ between two runs, or that one run lacks; both give a path once."""
    a = before.select("pdf_path", F.col("backend").alias("backend_a"), text.known(F.col("ocr_prob")).alias("prob_a"), F.lit(True).alias("in_a"))
    b = after.select("pdf_path", F.col("backend").alias("backend_b"), text.known(F.col("ocr_prob")).alias("prob_b"), F.lit(True).alias("in_b"))
    far = F.coalesce(F.abs(F.col("prob_a") - F.col("prob_b")) > tolerance, F.col("prob_a").isNull() != F.col("prob_b").isNull())
    change = F.when(F.col("in_a").isNull(), "added").when(F.col("in_b").isNull(), "removed").when(~F.col("backend_a").eqNullSafe(F.col("backend_b")), "backend").when(far, "ocr_prob")
    return a.join(b, "pdf_path", "full_outer").select("pdf_path", change.alias("change")).where("change IS NOT NULL")


def daily(results: DataFrame) -> DataFrame:
    """Per day and backend: results, failures, fallbacks (a lane other than the routed one) and their rates."""
    rows = distinct_results(results).where("ingested_at IS NOT NULL").groupBy(F.to_date("ingested_at").alias("day"), F.coalesce("backend", F.lit("NULL")).alias("backend"))
    other = F.coalesce(F.col("stage_b_backend") != F.col("backend"), F.lit(False))
    return rows.agg(F.count("*").alias("n"), F.count("error_class").alias("failures"), F.count_if(other).alias("fallbacks"), F.round(F.count("error_class") / F.count("*"), 6).alias("failure_rate"))


def view_bundle(results: DataFrame) -> DataFrame:
    """One row: totals, distributions, histograms with their edges and percentiles of a run as one JSON document; its rows stay a table (``view_rows``)."""
    rows = distinct_results(results)
    bins = F.array_sort(F.collect_list(F.struct("bin", "edge", "n")))
    hist = lambda c, hi: histogram(rows, c, 0.0, hi).agg(F.transform(bins, lambda s: s["n"]).alias(f"hist_{c}"), F.transform(bins, lambda s: s["edge"]).alias(f"edges_{c}"))
    spread = distributions(results).agg(F.array_sort(F.collect_list(F.struct("dimension", "value", "n"))).alias("distributions"))
    chars = percentiles(rows, "markdown_chars").select(F.struct("*").alias("percentiles_chars"))
    parts = [x.withColumn("one", F.lit(1)) for x in (run_summary(results), hist("ocr_prob", 1.0), hist("quality_score", 3.0), spread, chars)]
    whole = parts[0]
    for part in parts[1:]:  # one row each
        whole = whole.join(part, "one", "left")
    return whole.drop("one").select(F.to_json(F.struct("*")).alias("bundle"))


def shown_flags() -> tuple[Column, Column]:
    """What a demo shows of a routing: the garbled share above one percent, and the probability, 0 where it is missing or NaN."""
    garbled = F.col("garbled_text_ratio")
    return F.when(garbled > 0.01, garbled).alias("shown_garbled"), F.coalesce(text.known(F.col("ocr_prob")), F.lit(0.0)).alias("shown_prob")
