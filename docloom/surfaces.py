"""Queries over page features, caches, sinks read back, providers and review functions, each with its SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docloom import schema
from docloom.catalogue import _LATEST, _RESULTS, _SEGMENTS, _STRIP, _results, _segments, query
from docloom.functions import geometry, text
from docloom.operators import curation, features, layout, reports, review, routing
from docloom.plans import providers
from docloom.session import drop_folder, shared_folder, table
from docloom.sources import readers, writers

# page features


def _spans(spark, d):
    """Text spans as a parser gives them, from segments: the index stands for the font and for what is hidden."""
    s = _segments(spark, d).where("bbox IS NOT NULL AND content IS NOT NULL")
    return s.select(F.col("sha256").alias("doc"), F.col("page_index").alias("page"), F.col("seg_type").alias("font"), F.col("content").alias("text"), F.when(F.col("seg_index") % 5 == 4, 3).otherwise(0).alias("type"), F.lit(1.0).alias("opacity"), geometry.width(F.col("bbox")).alias("width"), geometry.height(F.col("bbox")).alias("height"), F.lit(1.0).alias("page_width"), F.lit(1.0).alias("page_height"))


_PART = "coalesce(sum(length(content)) FILTER (WHERE %(w)s), 0)::BIGINT %(p)schar_counts, count(*) FILTER (WHERE %(w)s) %(p)stext_box_counts, round(coalesce(sum(a) FILTER (WHERE %(w)s) / nullif(count(*) FILTER (WHERE %(w)s), 0), 0), 11)::DOUBLE %(p)savg_text_box_lengths, round(coalesce(sum(a) FILTER (WHERE %(w)s), 0), 11)::DOUBLE %(p)stext_area_ratios"


@query(_SEGMENTS + ", b AS (SELECT *, (bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0) a FROM s WHERE bbox IS NOT NULL AND content IS NOT NULL) SELECT sha256 doc, page_index page, count(DISTINCT seg_type) unique_font_counts, " + _PART % {"w": "seg_index % 5 <> 4", "p": ""} + ", " + _PART % {"w": "seg_index % 5 = 4", "p": "hidden_"} + " FROM b GROUP BY 1, 2")
def page_text_features(spark, d):
    rows = features.text_features(_spans(spark, d))
    rounded = [c for c in rows.columns if c.endswith(("lengths", "ratios"))]
    return rows.select(*(F.round(c, 11).alias(c) if c in rounded else c for c in rows.columns))


def _images(spark, d):
    """Pictures of pages, from segments: those at the same place of a page are one object of the file."""
    s = _segments(spark, d).where("bbox IS NOT NULL AND sha256 IS NOT NULL")
    pages = s.groupBy("sha256").agg(F.count_distinct("page_index").cast("int").alias("n_pages"))
    return s.join(pages, "sha256").select(F.col("sha256").alias("doc"), F.col("page_index").alias("page"), (F.col("seg_index") % 3).cast("bigint").alias("xref"), "n_pages", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1", F.lit(1.0).alias("page_width"), F.lit(1.0).alias("page_height"))


@query(_SEGMENTS + """, p AS (SELECT sha256, count(DISTINCT page_index) n_pages FROM s WHERE bbox IS NOT NULL GROUP BY 1),
i AS (SELECT sha256 doc, page_index page, seg_index % 3 xref, n_pages FROM s JOIN p USING (sha256) WHERE bbox IS NOT NULL),
j AS (SELECT doc, xref FROM i GROUP BY 1, 2 HAVING max(n_pages) >= 3 AND count(DISTINCT page) = max(n_pages))
SELECT i.doc, i.page, count(*) image_counts, count(*) FILTER (WHERE j.doc IS NULL) non_junk_image_counts FROM i LEFT JOIN j ON i.doc = j.doc AND i.xref = j.xref GROUP BY 1, 2""")
def page_image_features(spark, d):
    return features.image_features(_images(spark, d)).select("doc", "page", "image_counts", "non_junk_image_counts")


@query(_SEGMENTS + "SELECT sha256 doc, page_index page, count(*) FILTER (WHERE seg_type IN ('text', 'table') OR seg_type = 'image' AND seg_index % 2 = 0) drawing_strokes_count, count(DISTINCT seg_index) vector_graphics_obj_count FROM s GROUP BY 1, 2")
def page_drawing_features(spark, d):
    item = F.create_map(*(F.lit(x) for x in ("text", "l", "table", "c", "image", "re", "formula", "w")))
    s = _segments(spark, d).select(F.col("sha256").alias("doc"), F.col("page_index").alias("page"), F.col("seg_index").alias("path"), F.try_element_at(item, F.col("seg_type")).alias("item"), (F.col("seg_index") % 2 == 0).alias("stroked"))
    return features.drawing_features(s)


@query(_SEGMENTS + "SELECT seg_id, round(bbox.x1 - bbox.x0, 9) w, round(bbox.y1 - bbox.y0, 9) h, round((bbox.x1 - bbox.x0) * (bbox.y1 - bbox.y0), 12) a, round(bbox.x0 * 612, 9) px0, round(bbox.y1 * 792, 9) py1 FROM s WHERE bbox IS NOT NULL")
def box_arithmetic(spark, d):
    b = F.col("bbox")
    px = geometry.to_points(b, F.lit(612.0), F.lit(792.0))
    return _segments(spark, d).where("bbox IS NOT NULL").select("seg_id", F.round(geometry.width(b), 9).alias("w"), F.round(geometry.height(b), 9).alias("h"), F.round(geometry.area(b), 12).alias("a"), F.round(px[0], 9).alias("px0"), F.round(px[3], 9).alias("py1"))


_DOC_COLUMNS = ", ".join(f"coalesce(features['{c}'], 0.0) \"{c}\"" for c in features.vector_columns())


@query(f"SELECT DISTINCT pdf_path, {_DOC_COLUMNS} FROM router_decisions")
def features_all_columns(spark, d):
    return features.vectors(table(spark, d, "router_decisions")).distinct()


@query("SELECT DISTINCT pdf_path, CASE WHEN garbled_text_ratio > 0.01 THEN garbled_text_ratio END shown_garbled, CASE WHEN ocr_prob IS NULL OR ocr_prob::VARCHAR = 'nan' THEN 0.0 ELSE ocr_prob END shown_prob FROM router_decisions")
def demo_flags(spark, d):
    return table(spark, d, "router_decisions").select("pdf_path", *reports.shown_flags()).distinct()


# layout


@query(_SEGMENTS + "SELECT seg_id, CASE WHEN seg_type = 'image' THEN 'image' WHEN seg_type IN ('table', 'formula') THEN seg_type ELSE 'text' END pp, CASE WHEN seg_index % 7 = 0 THEN NULL WHEN seg_type = 'table' THEN 'table' ELSE 'text' END yolo FROM s")
def region_labels(spark, d):
    label = F.when(F.col("seg_index") % 7 == 0, "abandon").otherwise(F.col("seg_type"))
    return _segments(spark, d).select("seg_id", layout.region_type(F.upper("seg_type"), "pp").alias("pp"), layout.region_type(label, "yolo").alias("yolo"))


@query(_SEGMENTS + f"SELECT seg_id, row_number() OVER (PARTITION BY sha256, backend ORDER BY page_index, seg_index, seg_id) - 1 emitted FROM s WHERE {_STRIP % 'content'} <> ''")
def segment_numbers(spark, d):
    return layout.segment_index(_segments(spark, d)).select("seg_id", "emitted")


@query(_SEGMENTS + f"SELECT seg_id, md5(CASE WHEN seg_type = 'image' THEN '[image]' ELSE content END) body FROM s")
def ocr_lane_text(spark, d):
    return _segments(spark, d).select("seg_id", F.md5(layout.segment_text(F.col("seg_type"), F.col("content"))).alias("body"))


@query(_SEGMENTS + "SELECT sha256, page_index, unnest(generate_series(0, least(n, 2) - 1)) AS i FROM (SELECT sha256, page_index, count(*) n FROM s WHERE sha256 IS NOT NULL GROUP BY 1, 2)")
def zipped_regions(spark, d):
    pages = _segments(spark, d).where("sha256 IS NOT NULL").groupBy("sha256", "page_index").agg(F.array_sort(F.collect_list("seg_id")).alias("regions"))
    pairs = layout.zipped(F.col("regions"), F.array(F.lit("a"), F.lit("b")))
    return pages.select("sha256", "page_index", F.posexplode(pairs).alias("i", "pair")).select("sha256", "page_index", F.col("i").cast("bigint").alias("i"))


def _layouts(spark, d, tag="rules@1"):
    """Layouts of the pipeline's segments, nested as the cache holds them."""
    s = _segments(spark, d).where("bbox IS NOT NULL AND backend = 'pipeline' AND sha256 IS NOT NULL")
    region = F.struct(text.region_id(F.col("page_index"), F.col("seg_index")).alias("region_id"), F.col("seg_type").alias("type"), "bbox", F.lit(0.9).alias("confidence"), F.col("seg_index").alias("reading_order"))
    pages = s.groupBy("sha256", "page_index").agg(F.array_sort(F.collect_list(F.struct("seg_index", region.alias("r")))).alias("rs"))
    page = F.struct(F.col("page_index").alias("index"), F.lit(612.0).alias("page_width_pt"), F.lit(792.0).alias("page_height_pt"), F.transform("rs", lambda x: x["r"]).alias("regions"))
    return pages.groupBy("sha256").agg(F.array_sort(F.collect_list(F.struct("page_index", page.alias("p")))).alias("ps")).select("sha256", F.lit(tag).alias("layout_model"), F.transform("ps", lambda x: x["p"]).cast(f"array<{schema.PAGE}>").alias("pages"))


def _through(spark, name, write, read):
    """What ``read`` finds of what ``write`` leaves in a new folder, made whole before the folder goes."""
    folder = shared_folder(spark, name)
    try:
        write(folder)
        found = read(folder)
        return spark.createDataFrame(found.toArrow(), found.schema)
    finally:
        drop_folder(spark, folder)


@query(_SEGMENTS + "SELECT sha256, page_index page_idx, 'p' || page_index || '_r' || seg_index region_id, seg_type AS \"type\", seg_index AS \"order\" FROM s WHERE bbox IS NOT NULL AND backend = 'pipeline' AND sha256 IS NOT NULL")
def layout_cache(spark, d):
    """Layouts saved twice, read back by model tag, flattened: the second save takes the place of the first."""

    def write(folder):
        for tag in ("old@1", "rules@1", "rules@1"):
            writers.save_layouts(_layouts(spark, d, tag), folder)

    return _through(spark, "layouts", write, lambda folder: layout.flattened(readers.cached_layouts(spark, folder).where("layout_model = 'rules@1'")).select("sha256", "page_idx", "region_id", "type", "order"))


@query(_SEGMENTS + ", lay AS (SELECT sha256, bool_or(coalesce(seg_type IN ('table', 'formula'), false)) hard FROM s WHERE bbox IS NOT NULL AND backend = 'pipeline' AND sha256 IS NOT NULL GROUP BY 1) SELECT k.sha256, hard has_complex_content, CASE WHEN hard THEN 'deferred' WHEN NOT hard THEN 'pipeline' END stage_b FROM (SELECT DISTINCT sha256 FROM router_decisions WHERE sha256 IS NOT NULL) k LEFT JOIN lay USING (sha256)")
def stage_b_from_cache(spark, d):
    keys = table(spark, d, "router_decisions").where("sha256 IS NOT NULL").select("sha256").distinct()
    return routing.stage_b_cached(keys, _layouts(spark, d))


# sinks, read back


@query(f"SELECT sha256, is_bad, stage FROM {_LATEST}")
def flags_log(spark, d):
    """The log written in two appends, read back tolerantly, its latest state."""
    log = table(spark, d, "badcases")

    def write(folder):
        for bad in (True, False):
            writers.append_log(log.where(F.coalesce("is_bad", F.lit(False)) == bad), folder)

    return _through(spark, "badcases", write, lambda folder: review.latest_flags(readers.bad_case_log(spark, folder)).select("sha256", "is_bad", "stage"))


_TABLE_SQL = ", ".join({"markdown": "md5(nullif(m.markdown, '')) markdown", "markdown_chars": "coalesce(markdown_chars, 0) markdown_chars", "ocr_prob": "CASE WHEN ocr_prob::VARCHAR <> 'nan' THEN ocr_prob END ocr_prob", "error_message": "substr(error_message, 1, 500) error_message", "wall_ms_total": "round(coalesce(wall_ms_router, 0) + coalesce(wall_ms_layout, 0) + coalesce(wall_ms_extract, 0) + coalesce(wall_ms_quality, 0), 3)::DOUBLE wall_ms_total", "kept": "(error_class IS NULL AND coalesce(quality_score >= 2.0 AND quality_score::VARCHAR <> 'nan', false)) kept"}.get(n, f"r.{n}") for n, _ in schema.RESULT_TABLE)


@query(_RESULTS + f"SELECT {_TABLE_SQL} FROM r LEFT JOIN (SELECT sha256, backend, max(markdown) markdown FROM extracted_docs GROUP BY 1, 2) m ON r.sha256 = m.sha256 AND r.extract_backend = m.backend")
def published_table(spark, d):
    """All columns of the published table as they come back from its file."""
    rows = reports.result_table(table(spark, d, "doc_results"), table(spark, d, "extracted_docs"))
    return _through(spark, "published", lambda folder: writers.publish(rows, folder), lambda folder: readers.result_table(spark, folder).withColumn("markdown", F.md5("markdown")).withColumn("wall_ms_total", F.round("wall_ms_total", 3)))


@query(_RESULTS + "SELECT result_id, coalesce(extract_backend, 'none') lang, coalesce(source, 'none') source, CASE WHEN quality_score IS NULL OR quality_score::VARCHAR = 'nan' THEN 'none' WHEN quality_score < 1.0 THEN 'low' WHEN quality_score < 2.0 THEN 'mid' ELSE 'high' END quality_bucket FROM r")
def packaged(spark, d):
    """Results packaged by language, source and quality bucket, as both its forms give them back."""
    rows = _results(spark, d).select(F.col("result_id").alias("id"), F.col("extract_backend").alias("lang"), "source", curation.quality_bucket(F.col("quality_score")).alias("quality_bucket"), F.lit("x").alias("body"))
    names = ["id", "lang", "source", "quality_bucket"]

    def read(folder):
        a = spark.read.parquet(f"{folder}/parquet").select(*names)
        b = spark.read.json(f"{folder}/jsonl").select(*names)
        return a.intersectAll(b).withColumnRenamed("id", "result_id")

    return _through(spark, "package", lambda folder: writers.package(rows, folder), read)


@query(_RESULTS + "SELECT result_id, error_class FROM r WHERE error_class IS NOT NULL")
def quarantined(spark, d):
    rows = _results(spark, d).select("result_id", "error_class", "error_message")
    return _through(spark, "quarantine", lambda folder: writers.quarantine(rows, folder), lambda folder: spark.read.parquet(folder).select("result_id", "error_class"))


@query("SELECT sha256, md5(min(markdown)) digest FROM (SELECT DISTINCT sha256, markdown FROM extracted_docs WHERE backend = 'mupdf' AND markdown <> '' AND sha256 IS NOT NULL) GROUP BY 1")
def markdown_dump(spark, d):
    docs = table(spark, d, "extracted_docs").where("backend = 'mupdf'").select("sha256", "markdown")
    return _through(spark, "markdown", lambda folder: writers.markdown_files(docs, folder), lambda folder: spark.read.parquet(folder).select("sha256", F.md5("markdown").alias("digest")))


@query("SELECT id, \"label\" FROM (SELECT sha256 id, max(stage) \"label\" FROM badcases WHERE sha256 <> '' GROUP BY 1) WHERE \"label\" IS NOT NULL")
def labels_snapshot(spark, d):
    """Labels written as a version of the annotations and read back, those with a label."""
    rows = table(spark, d, "badcases").where("sha256 <> ''").groupBy(F.col("sha256").alias("id")).agg(F.max("stage").alias("label"))
    return _through(spark, "labels", lambda folder: writers.snapshot(rows, folder, "1"), lambda folder: spark.read.schema("id string, label string").json(f"{folder}/version=1").where("label IS NOT NULL").select("id", "label"))


# providers and texts


@query(f"""SELECT DISTINCT ext_id, CASE WHEN t = '' THEN 0.0 ELSE least(3.0, (length(substr(t, 1, 10000)) % 50) / 10.0) END score FROM (SELECT ext_id, {_STRIP % "coalesce(markdown, '')"} t FROM extracted_docs)""")
def provider_scores(spark, d):
    """A scorer provider over texts, in Arrow batches."""
    score = providers.scorer(lambda: lambda texts: [len(t) % 50 / 10.0 for t in texts])
    docs = table(spark, d, "extracted_docs").select("ext_id", "markdown").distinct()
    return docs.select("ext_id", score(F.col("markdown")).alias("score"))


@query("SELECT DISTINCT pdf_path, least(1.0, coalesce(features['num_pages_successfully_sampled'], 0.0) / 10) prob FROM router_decisions")
def provider_router(spark, d):
    """A router provider over all feature columns, one call a batch."""
    prob = providers.router(lambda: lambda frame: (frame["num_pages_successfully_sampled"] / 10).clip(upper=1.0))
    return features.vectors(table(spark, d, "router_decisions")).select("pdf_path", prob().alias("prob")).distinct()


@query("SELECT doc_id, page, error FROM (SELECT doc_id, unnest(CASE WHEN n > 3 THEN [0, 1, 2] WHEN n > 0 THEN generate_series(0, n - 1) ELSE [0] END)::INTEGER page, CASE WHEN n = 0 THEN 'ValueError: no text' END error FROM (SELECT doc_id, len(string_split(text, chr(10) || chr(10)))::INTEGER * (text <> '')::INTEGER n FROM documents WHERE text IS NOT NULL))")
def provider_parser(spark, d):
    """A parser provider over bytes: a document that it can't read is a row with its error."""

    def make():
        def parse(blob: bytes) -> list[dict]:
            if not blob:
                raise ValueError("no text")
            return [{"page": i} for i in range(min(3, blob.count(b"\n\n") + 1))]

        return parse

    docs = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.encode("text", "utf-8").alias("content"))
    return providers.parser(docs, make, "doc_id bigint, page int, error string", key="doc_id").withColumn("page", F.coalesce("page", F.lit(0)))


@query(_RESULTS + "SELECT result_id, CASE WHEN quality_score IS NULL OR quality_score::VARCHAR = 'nan' THEN 0.0 ELSE greatest(0.0, least(3.0, quality_score)) END score, CASE WHEN quality_score IS NULL OR quality_score::VARCHAR = 'nan' THEN '' ELSE 'fine' END reason FROM r")
def reply_scores(spark, d):
    """Replies of a scoring model, fenced or among prose, parsed."""
    known = F.when(~F.isnan("quality_score"), F.col("quality_score"))
    body = F.concat(F.lit('{"score": '), known.cast("decimal(20,16)").cast("string"), F.lit(', "reason": "fine"}'))
    reply = F.when(F.col("result_id") % 3 == 0, body).when(F.col("result_id") % 3 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("I think: "), body, F.lit(" .")))
    parsed = text.parse_reply(F.coalesce(reply, F.lit("no idea")))
    return _results(spark, d).select("result_id", parsed.alias("p")).select("result_id", "p.score", "p.reason")


@query("SELECT doc_id, md5('data:image/' || CASE doc_id % 4 WHEN 0 THEN 'png' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'webp' ELSE 'gif' END || ';base64,' || base64(encode(text))) url FROM documents WHERE text IS NOT NULL")
def picture_urls(spark, d):
    path = F.concat(F.lit("a/b."), F.element_at(F.array(*map(F.lit, ("PNG", "jpg", "webp", "gif"))), (F.col("doc_id") % 4 + 1).cast("int")))
    url = text.data_url(F.encode("text", "utf-8"), path)
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(F.replace(url, F.lit("\r\n"), F.lit(""))).alias("url"))


@query("SELECT doc_id, CASE WHEN length(text) >= 1048576 THEN printf('%.1f MB', length(text) / 1048576.0) WHEN length(text) >= 1024 THEN printf('%.1f KB', length(text) / 1024.0) ELSE printf('%.1f B', length(text)::DOUBLE) END size FROM documents WHERE text IS NOT NULL")
def size_texts(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", text.size_text(F.length("text")).alias("size"))


@query(_RESULTS + "SELECT result_id, strftime(to_timestamp(floor(started_at)::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') started FROM r WHERE started_at IS NOT NULL AND started_at::VARCHAR <> 'nan'")
def start_times(spark, d):
    return _results(spark, d).where("started_at IS NOT NULL AND NOT isnan(started_at)").select("result_id", text.utc_text(F.col("started_at")).alias("started"))


@query("SELECT DISTINCT pdf_path, split_part(pdf_path, '/', 2) folder, 'mupdf' backend FROM router_decisions WHERE pdf_path NOT LIKE '%\\%%' AND pdf_path NOT LIKE '%+%'")
def request_paths(spark, d):
    """Paths and parameters of requests, parsed and unquoted."""
    docs = table(spark, d, "router_decisions").select("pdf_path").distinct()
    url = F.concat(F.lit("http://host/"), F.replace(F.url_encode("pdf_path"), F.lit("%2F"), F.lit("/")), F.lit("?backend=mupdf"))
    path, backend = text.request(url, "backend")
    return docs.select("pdf_path", F.split(path, "/")[1].alias("folder"), backend.alias("backend"))


@query(_RESULTS + "SELECT count(*) num_pdfs, count(*) FILTER (WHERE router_error IS NOT NULL OR coalesce(starts_with(error_class, 'extract'), false)) num_errors, count(*) FILTER (WHERE quality_score::VARCHAR <> 'nan') num_scored, (SELECT '{' || string_agg('\"' || b || '\":' || n, ',' ORDER BY b) || '}' FROM (SELECT coalesce(stage_b_backend, backend) b, count(*) n FROM r WHERE coalesce(stage_b_backend, backend) IS NOT NULL GROUP BY 1)) by_backend FROM r")
def bench_summary(spark, d):
    return reports.bench_summary(table(spark, d, "doc_results"))


_FLAGGED = pd.DataFrame([review.flag("a" * 64, stage="layout", note="x" * 1200, at="2024-01-02"), review.flag("b" * 64, tags=["t"], at="2024-01-01"), review.unflag("b" * 64, at="2024-01-03")])


@query("SELECT repeat('a', 64) sha256, 'layout' stage, 1000::INTEGER n_note")
def flags_by_function(spark, d):
    """Flags made and withdrawn by functions, and what is left of them."""
    log = spark.createDataFrame(_FLAGGED, schema.BAD_CASES)
    return review.active_flags(log).select("sha256", "stage", F.length("note").alias("n_note"))
