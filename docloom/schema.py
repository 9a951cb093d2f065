"""Types of the tables that flow through the engine. Unknown input fields are ignored, missing ones are NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The domains of type and backend columns, error classes and review stages.
REGION_TYPES = ("text", "image", "table", "formula")
COMPLEX_TYPES = ("table", "formula")
BACKENDS = ("mupdf", "pipeline", "vlm", "deferred")
ERROR_CLASSES = ("router", "layout", "extract_mupdf", "extract_pipeline", "extract_vlm", "quality")
REVIEW_STAGES = ("router", "layout", "extract", "quality", "overall")

BBOX = "struct<x0:double,y0:double,x1:double,y1:double>"
REGION = f"struct<region_id:string,type:string,bbox:{BBOX},confidence:double,reading_order:int>"
PAGE = f"struct<index:int,page_width_pt:double,page_height_pt:double,regions:array<{REGION}>>"


PDF_RECORD = "sha256 string, source_uri string, size_bytes bigint, mime string, discovered_at double, provenance string"
LAYOUT = f"sha256 string, layout_model string, pages array<{PAGE}>"
SEGMENTS = f"sha256 string, seg_index int, backend string, page_index int, seg_type string, content string, bbox {BBOX}, source_region_id string"
EXTRACTED = "sha256 string, backend string, markdown string, stats map<string,string>"
ROUTER = "backend string, ocr_prob double, num_pages int, is_form boolean, garbled_text_ratio double, is_encrypted boolean, needs_password boolean, features map<string,double>, router_error string"
STAGE_B = "backend string, has_complex_content boolean, layout_model string, num_pages int, num_regions int, num_complex_regions int"
BAD_CASES = "sha256 string, is_bad boolean, stage string, tags array<string>, note string, flagged_at string, flagged_by string"
ANNOTATIONS = "id string, label string, ocr_reasons array<string>, n_ocr_pages int, reason_short string, custom_tags array<string>, annotator string, annotated_at string"
QUALITY = "score double, num_chars int, num_tokens int, model string, reason string, raw_content string, parse_error string"
EXCERPT = "array<struct<page_index:int,type:string,bbox:array<double>,content:string>>"

#: The published table: name and type of its columns, in order.
RESULT_TABLE = tuple(
    tuple(c.split())
    for c in (
        "pdf_path string, sha256 string, backend string, stage_b_backend string, ocr_prob double, num_pages int, is_form boolean, garbled_text_ratio double, is_encrypted boolean, layout_model string, "
        "layout_num_regions int, layout_has_complex boolean, extract_backend string, markdown string, markdown_chars bigint, quality_score double, quality_model string, error_class string, "
        "error_message string, segments_excerpt string, region_failures int, kept boolean, wall_ms_total double"
    ).split(", ")
)


def in_domain(column: Column, domain: tuple[str, ...]) -> Column:
    """Whether a value belongs to a domain; NULL stays NULL."""
    return column.isin(*domain)
