"""Regions, reading order, segments and the texts merged from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import geometry, text
from docloom.schema import COMPLEX_TYPES

#: Labels of the detector that is read as written, by region type; any other label is text.
YOLO_LABELS = {
    "figure": "image",
    "Figure": "image",
    "table": "table",
    "Table": "table",
    "isolate_formula": "formula",
    "Isolate formula": "formula",
}
#: Labels of the detector that is read in lower case, by region type; any other label is text.
PP_LABELS = {
    "figure": "image",
    "image": "image",
    "seal": "image",
    "table": "table",
    "formula": "formula",
    "equation": "formula",
}
#: Labels of the first detector that make no region.
YOLO_SKIPPED = ("abandon", "Abandon")
#: Region types as a vision model names them.
VISION_TYPES = {"formula": "equation"}


def region_type(label: Column, detector: str = "yolo") -> Column:
    """Type of a detector's label, "yolo" as written, "pp" in lower case; NULL for labels to skip, text for unknown and missing ones."""
    labels, seen, skipped = (YOLO_LABELS, label, YOLO_SKIPPED) if detector == "yolo" else (PP_LABELS, F.lower(label), ())
    kinds = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    kind = F.coalesce(F.try_element_at(kinds, seen), F.lit("text"))
    return F.when(label.isNull() | ~label.isin(*skipped), kind) if skipped else kind


def detected(detections: DataFrame, confidence: float = 0.25, detector: str = "yolo") -> DataFrame:
    """Regions from detections (sha256, page_index, label, confidence, bbox, det_index): typed, clamped, confident, in reading order.

    Order is by (y0, x0), ties by the detector's; region_id follows from it. Boxes that leave nothing on the page drop out.
    """
    order = Window.partitionBy("sha256", "page_index").orderBy("bbox.y0", "bbox.x0", "det_index")
    return (
        detections.withColumn("type", region_type(F.col("label"), detector))
        .withColumn("bbox", geometry.clamped(F.col("bbox")))
        .where(F.col("type").isNotNull() & F.col("bbox").isNotNull() & (F.col("confidence") >= confidence))
        .withColumn("reading_order", F.row_number().over(order) - 1)
        .withColumn("region_id", text.region_id(F.col("page_index"), F.col("reading_order")))
    )


def reading_order(segments: DataFrame) -> DataFrame:
    """Segments with a box, numbered within their page by (y0, x0, seg_index), and the region_id of that number."""
    order = Window.partitionBy("sha256", "backend", "page_index").orderBy("bbox.y0", "bbox.x0", "seg_index", "seg_id")
    numbered = segments.where("bbox IS NOT NULL").withColumn("reading_order", F.row_number().over(order) - 1)
    return numbered.withColumn("region_id", text.region_id(F.col("page_index"), F.col("reading_order")))


def complex_pages(segments: DataFrame) -> DataFrame:
    """All segments of pages that hold a table or formula."""
    hard = segments.where(F.col("seg_type").isin(*COMPLEX_TYPES)).select("sha256", "backend", "page_index").distinct()
    return segments.join(hard, ["sha256", "backend", "page_index"], "left_semi")


def segment_text(kind: Column, content: Column) -> Column:
    """Content of a region in the OCR lane: pictures become a placeholder."""
    return F.when(kind == "image", "[image]").otherwise(content)


def merged(segments: DataFrame) -> DataFrame:
    """(sha256, backend, markdown): contents in order of seg_index by the merge rule; rows delivered twice count once."""
    rows = segments.select("sha256", "backend", "seg_index", "content").distinct()
    ordered = F.array_sort(F.collect_list(F.struct("seg_index", text.strip(F.coalesce("content", F.lit(""))).alias("content"))))
    return rows.groupBy("sha256", "backend").agg(text.merge_markdown(F.transform(ordered, lambda s: s["content"])).alias("markdown"))


def parser_stats(segments: DataFrame) -> DataFrame:
    """Per document: segments, their characters, pages, counts by type and the pages with tables or formulas, sorted."""
    hard = F.when(F.col("seg_type").isin(*COMPLEX_TYPES), F.col("page_index"))
    count = lambda k: F.count_if(F.col("seg_type") == k).alias(f"n_{k}")
    return segments.groupBy("sha256", "backend").agg(
        F.count("*").alias("segment_count"),
        F.coalesce(F.sum(F.length("content")), F.lit(0)).cast("bigint").alias("char_count"),
        F.count_distinct("page_index").alias("page_count"),
        *(count(k) for k in ("text", "image", "table", "formula")),
        F.count_if(F.coalesce(text.strip(F.col("content")) == "", F.lit(True))).alias("region_failures"),
        F.array_join(F.transform(F.array_sort(F.collect_set(hard)), lambda p: p.cast("string")), ",").alias("complex_pages"),
    )


def excerpt(segments: DataFrame, most: int = 200) -> DataFrame:
    """(sha256, backend, segments_excerpt): per document the JSON array of its segments, contents cut."""
    box = F.when(F.col("bbox").isNotNull(), F.array("bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1"))
    item = F.struct("seg_index", F.struct("page_index", F.col("seg_type").alias("type"), box.alias("bbox"), F.substring(F.coalesce("content", F.lit("")), 1, most).alias("content")).alias("s"))
    rows = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"])
    return segments.groupBy("sha256", "backend").agg(text.excerpt_json(rows).alias("segments_excerpt"))


def preview_rows(segments: DataFrame) -> DataFrame:
    """Segments for a listing: box rounded to four places, characters, a preview of 120 with line feeds as spaces."""
    corner = [F.round(F.col(f"bbox.{k}"), 4).alias(k) for k in ("x0", "y0", "x1", "y1")]
    body = F.coalesce("content", F.lit(""))
    return segments.select("seg_id", "page_index", "seg_type", *corner, F.length(body).cast("bigint").alias("chars"), F.translate(F.substring(body, 1, 120), "\n", " ").alias("preview"))


def flattened(layouts: DataFrame) -> DataFrame:
    """Regions of nested layouts as rows: sha256, layout_model, page_idx, region_id, type, bbox (array), confidence, order."""
    page = layouts.select("sha256", "layout_model", F.explode("pages").alias("p"))
    rows = page.select("sha256", "layout_model", F.col("p.index").alias("page_idx"), F.explode("p.regions").alias("r"))
    box = F.array(*(F.coalesce(F.col(f"r.bbox.{k}"), F.lit(0.0)) for k in ("x0", "y0", "x1", "y1")))
    return rows.select("sha256", "layout_model", "page_idx", "r.region_id", F.coalesce("r.type", F.lit("text")).alias("type"), box.alias("bbox"), F.coalesce("r.confidence", F.lit(0.0)).alias("confidence"), F.col("r.reading_order").alias("order"))


def segment_index(segments: DataFrame) -> DataFrame:
    """Segments with content, numbered from 0 within their document in order of page and index: ``emitted``."""
    order = Window.partitionBy("sha256", "backend").orderBy("page_index", "seg_index", "seg_id")
    return segments.where(text.strip(F.coalesce("content", F.lit(""))) != "").withColumn("emitted", (F.row_number().over(order) - 1).cast("bigint"))


def zipped(regions: Column, results: Column) -> Column:
    """Pairs of regions and results by position, as far as both go."""
    n = F.least(F.size(regions), F.size(results))
    return F.arrays_zip(F.slice(regions, 1, n).alias("region"), F.slice(results, 1, n).alias("result"))
