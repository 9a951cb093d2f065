"""Page features of documents and the vector that a router model takes."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import geometry
from docloom.functions.text import safe_ratio

#: Names of the model's features per document and per sampled page.
DOC_FEATURES = ("num_pages_successfully_sampled", "garbled_text_ratio", "is_form", "creator_or_producer_is_known_scanner")
PAGE_FEATURES = (
    "page_level_unique_font_counts",
    "page_level_char_counts",
    "page_level_text_box_counts",
    "page_level_avg_text_box_lengths",
    "page_level_text_area_ratios",
    "page_level_hidden_char_counts",
    "page_level_hidden_text_box_counts",
    "page_level_hidden_avg_text_box_lengths",
    "page_level_hidden_text_area_ratios",
    "page_level_image_counts",
    "page_level_non_junk_image_counts",
    "page_level_bitmap_proportions",
    "page_level_max_merged_strip_areas",
    "page_level_drawing_strokes_count",
    "page_level_vector_graphics_obj_count",
)
PAGES, SEED, JUNK_PAGES = 8, 42, 3


def vector_columns() -> list[str]:
    """The model's columns in order: 4 of the document and 15 of each of 8 pages."""
    return [*DOC_FEATURES, *(f"{name}_page{p}" for name in PAGE_FEATURES for p in range(1, PAGES + 1))]


def vectors(decisions: DataFrame, key: str = "pdf_path") -> DataFrame:
    """``key`` and the model's columns from the map ``features``; missing ones are 0, others are dropped."""
    value = lambda n: F.coalesce(F.try_element_at("features", F.lit(n)), F.lit(0.0)).alias(n)
    return decisions.select(key, *(value(n) for n in vector_columns()))


def long_features(decisions: DataFrame, key: str = "pdf_path") -> DataFrame:
    """(``key``, feature, value) rows of the map ``features``."""
    return decisions.select(key, F.explode("features").alias("feature", "value"))


def page_choice(total: int, most: int = PAGES) -> list[int]:
    """Pages (from 0) that stand for a document of ``total`` pages: a seeded sample without repetition, sorted."""
    return sorted(random.Random(SEED).sample(range(total), min(total, most)))


def padding(sampled: int, most: int = PAGES) -> list[int]:
    """Which of the sampled pages fill the places that are left, drawn with repetition from a seeded generator."""
    return np.random.RandomState(SEED).choice(sampled, most - sampled, replace=True).tolist() if 0 < sampled < most else []


def _draws(total: int) -> list[tuple[int, int, int]]:
    pages = page_choice(total)
    return [(total, slot + 1, page) for slot, page in enumerate(pages + [pages[i] for i in padding(len(pages))])]


def sample_table(spark: SparkSession, largest: int) -> DataFrame:
    """(num_pages, slot, page_index) for 1 to ``largest`` pages: draws depend on the page count only, so a join replaces them."""
    return spark.createDataFrame([row for total in range(1, largest + 1) for row in _draws(total)], "num_pages int, slot int, page_index int")


def page_samples(documents: DataFrame) -> DataFrame:
    """(pdf_path, num_pages, slot, page_index) of each distinct document (pdf_path, num_pages) with pages; draws are made once a page count that occurs."""

    def run(batches):
        for batch in batches:
            rows = [row for total in batch.column(0).to_pylist() for row in _draws(total)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32()) for i in range(3)], names=["num_pages", "slot", "page_index"])

    pages = documents.where("num_pages > 0").select("pdf_path", F.col("num_pages").cast("int").alias("num_pages")).distinct()
    return pages.join(pages.select("num_pages").distinct().mapInArrow(run, "num_pages int, slot int, page_index int"), "num_pages")


def text_features(spans: DataFrame) -> DataFrame:
    """Per (doc, page) of spans (doc, page, font, text, type, opacity, width, height, page_width, page_height): text features.

    Hidden text has type 3 or no opacity and is counted apart. A page without area has the text area ratio 1.
    """
    hidden = (F.coalesce("type", F.lit(0)) == 3) | (F.coalesce("opacity", F.lit(1.0)) == 0)
    chars, box = F.length("text"), F.col("width") * F.col("height")
    page = F.first("page_width") * F.first("page_height")

    def part(which, prefix: str) -> list:
        boxes, areas = F.count_if(which), F.sum(F.when(which, box))
        ratio = F.when(page > 0, F.coalesce(areas, F.lit(0.0)) / page).otherwise(1.0)
        return [
            F.coalesce(F.sum(F.when(which, chars)), F.lit(0)).cast("bigint").alias(f"{prefix}char_counts"),
            boxes.alias(f"{prefix}text_box_counts"),
            safe_ratio(F.coalesce(areas, F.lit(0.0)), boxes).alias(f"{prefix}avg_text_box_lengths"),
            ratio.alias(f"{prefix}text_area_ratios"),
        ]

    return spans.groupBy("doc", "page").agg(F.count_distinct(F.nullif("font", F.lit(""))).alias("unique_font_counts"), *part(~hidden, ""), *part(hidden, "hidden_"))


def junk_images(images: DataFrame) -> DataFrame:
    """(doc, xref) of pictures on every page of a document of at least ``JUNK_PAGES`` sampled pages; images (doc, page, xref, n_pages)."""
    return images.groupBy("doc", "xref").agg(F.count_distinct("page").alias("on"), F.first("n_pages").alias("n_pages")).where((F.col("n_pages") >= JUNK_PAGES) & (F.col("on") == F.col("n_pages"))).select("doc", "xref")


def image_features(images: DataFrame) -> DataFrame:
    """Per (doc, page) of images (doc, page, xref, n_pages, x0, y0, x1, y1, page_width, page_height): counts and merged areas."""
    flagged = images.join(junk_images(images).withColumn("junk", F.lit(True)), ["doc", "xref"], "left")
    boxes = F.collect_list(F.struct("x0", "y0", "x1", "y1", F.col("xref").alias("id")))
    page = flagged.groupBy("doc", "page").agg(F.count("*").alias("image_counts"), F.count_if(F.col("junk").isNull()).alias("non_junk_image_counts"), boxes.alias("boxes"), F.first("page_width").alias("w"), F.first("page_height").alias("h"))
    strips = page.withColumn("areas", F.transform(geometry.merged_strips(F.col("boxes"), F.col("w"), F.col("h")), lambda b: F.abs((b["x1"] - b["x0"]) * (b["y1"] - b["y0"]))))
    whole = F.col("w") * F.col("h")
    share = lambda a: F.when(whole > 0, a / whole).otherwise(1.0)
    total = F.aggregate("areas", F.lit(0.0), lambda a, x: a + x)
    return strips.select("doc", "page", "image_counts", "non_junk_image_counts", share(total).alias("bitmap_proportions"), share(F.array_max("areas")).alias("max_merged_strip_areas"))


def drawing_features(drawings: DataFrame) -> DataFrame:
    """Per (doc, page) of drawing items (doc, page, path, item, stroked): strokes and vector objects.

    A line, curve or quad item is a stroke, a stroked rectangle one more; each path is an object.
    """
    strokes = F.count_if(F.col("item").isin("l", "c", "q")) + F.count_if((F.col("item") == "re") & F.coalesce("stroked", F.lit(False)))
    return drawings.groupBy("doc", "page").agg(strokes.alias("drawing_strokes_count"), F.count_distinct("path").alias("vector_graphics_obj_count"))
