"""Every query of the core by name, and the same in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import config
from docloom.functions import geometry, text
from docloom.operators import curation, features, layout, neardup, reports, review, routing
from docloom.plans import pipeline
from docloom.session import is_folder, table
from docloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: SQL for each result once, and for white space as the engine's text functions see it.
_RESULTS = "WITH r AS (SELECT * FROM doc_results QUALIFY row_number() OVER (PARTITION BY result_id) = 1) "
_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = f"regexp_replace(%s, '^{_WS}+|{_WS}+$', '', 'g')"
_NORM = f"array_to_string(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: {_STRIP % f'''regexp_replace(p, '{_WS}+', ' ', 'g')'''}), lambda p: p <> ''), chr(10) || chr(10))"
_KEPT = "(error_class IS NULL AND coalesce(quality_score >= 2.0 AND quality_score::VARCHAR <> 'nan', false))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def _results(spark: SparkSession, d: str) -> DataFrame:
    return reports.distinct_results(table(spark, d, "doc_results"))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").dropDuplicates(["seg_id"])


_SEGMENTS = "WITH s AS (SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY seg_id) = 1) "


# acceptance queries over the result table


@query(_RESULTS + "SELECT count(*) n FROM r")
def accept_row_count(spark, d):
    return _results(spark, d).agg(F.count("*").alias("n"))


@query(_RESULTS + "SELECT extract_backend, count(*) n FROM r GROUP BY 1")
def accept_backend_mix(spark, d):
    return _results(spark, d).groupBy("extract_backend").agg(F.count("*").alias("n"))


@query(_RESULTS + f"SELECT count(*) FILTER (WHERE quality_score >= 2.0 AND quality_score::VARCHAR <> 'nan') n_high, count(*) FILTER (WHERE {_KEPT}) n_kept, count(*) FILTER (WHERE error_class IS NOT NULL) n_errors FROM r")
def accept_quality_dist(spark, d):
    high = (F.col("quality_score") >= 2.0) & ~F.isnan("quality_score")
    return _results(spark, d).agg(F.count_if(high).alias("n_high"), F.count_if(routing.kept(F.col("error_class"), F.col("quality_score"))).alias("n_kept"), F.count("error_class").alias("n_errors"))


@query(_RESULTS + "SELECT error_class, count(*) n FROM r WHERE error_class IS NOT NULL GROUP BY 1")
def accept_error_mix(spark, d):
    return reports.counts_by(table(spark, d, "doc_results"), F.col("error_class"), "error_class", skip_null=True)


@query(_RESULTS + "SELECT extract_backend, min(markdown_chars) least, max(markdown_chars) most, round(avg(markdown_chars), 6) mean FROM r WHERE markdown_chars IS NOT NULL GROUP BY 1")
def accept_markdown_len_by_backend(spark, d):
    c = "markdown_chars"
    return _results(spark, d).where(F.col(c).isNotNull()).groupBy("extract_backend").agg(F.min(c).alias("least"), F.max(c).alias("most"), F.round(F.avg(c), 6).alias("mean"))


@query("SELECT count(DISTINCT ext_id) n FROM extracted_docs WHERE markdown LIKE '%<table%' OR markdown LIKE '%| --- |%' OR markdown LIKE '%$$%'")
def accept_like_structured(spark, d):
    m = F.col("markdown")
    return table(spark, d, "extracted_docs").where(m.contains("<table") | m.contains("| --- |") | m.contains("$$")).agg(F.count_distinct("ext_id").alias("n"))


# sources and keys


@query("SELECT DISTINCT pdf_path FROM router_decisions ORDER BY 1 LIMIT 100")
def scan_sorted_limit(spark, d):
    return table(spark, d, "router_decisions").select("pdf_path").distinct().orderBy("pdf_path").limit(100)


@query("SELECT doc_id, sha256(text) sha256 FROM documents WHERE text IS NOT NULL")
def content_sha256(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("SELECT substr(sha256, 1, 2) shard, count(DISTINCT sha256) n FROM extracted_docs WHERE sha256 IS NOT NULL GROUP BY 1")
def shard_counts(spark, d):
    return table(spark, d, "extracted_docs").where("sha256 IS NOT NULL").groupBy(text.shard(F.col("sha256")).alias("shard")).agg(F.count_distinct("sha256").alias("n"))


@query("SELECT DISTINCT sha256, substr(sha256, 1, 2) || '/' || substr(sha256, 3, 2) || '/' || sha256 || '.model_v1@2.json' cache_path FROM extracted_docs WHERE length(sha256) >= 4")
def layout_cache_path(spark, d):
    path = text.cache_path(F.col("sha256"), F.lit("model/v1@2"))
    return table(spark, d, "extracted_docs").where(F.length("sha256") >= 4).select("sha256", path.alias("cache_path")).distinct()


@query("SELECT stage_shard shard, n FROM (SELECT substr(sha256, 1, 2) stage_shard, count(DISTINCT sha256) n FROM router_decisions WHERE sha256 IS NOT NULL GROUP BY 1) WHERE stage_shard NOT IN (SELECT substr(sha256, 1, 2) FROM doc_results WHERE sha256 IS NOT NULL AND error_class = 'quality')")
def shards_to_do(spark, d):
    shards = table(spark, d, "router_decisions").where("sha256 IS NOT NULL").groupBy(text.shard(F.col("sha256")).alias("shard")).agg(F.count_distinct("sha256").alias("n"))
    done = table(spark, d, "doc_results").where("sha256 IS NOT NULL AND error_class = 'quality'").select(text.shard(F.col("sha256")).alias("shard"), F.lit("quality").alias("stage"), F.lit("done").alias("status"))
    return curation.to_do(shards, done, "quality")


# text


@query(f"SELECT doc_id, md5({_NORM}) digest FROM documents WHERE text IS NOT NULL")
def normalize_text_md5(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("digest"))


@query(f"""WITH s AS (SELECT DISTINCT sha256, backend, seg_index, content FROM segments)
SELECT sha256, backend, md5({_STRIP % "coalesce(string_agg(c, chr(10) || chr(10) ORDER BY seg_index) FILTER (WHERE c <> ''), '')"} || chr(10)) digest
FROM (SELECT sha256, backend, seg_index, {_STRIP % "coalesce(content, '')"} c FROM s) GROUP BY 1, 2""")
def markdown_merge(spark, d):
    return layout.merged(table(spark, d, "segments")).select("sha256", "backend", F.md5("markdown").alias("digest"))


@query("SELECT DISTINCT ext_id, (length(markdown) - length(replace(markdown, chr(65533), '')))::BIGINT n_lost, round(coalesce((length(markdown) - length(replace(markdown, chr(65533), ''))) / nullif(length(markdown), 0), 0), 9)::DOUBLE ratio FROM extracted_docs WHERE markdown IS NOT NULL")
def garbled_ratio(spark, d):
    m = F.col("markdown")
    return table(spark, d, "extracted_docs").where(m.isNotNull()).select("ext_id", text.count_of(m, "�").alias("n_lost"), F.round(text.garbled_ratio(m), 9).alias("ratio")).distinct()


@query(r"SELECT doc_id, round(coalesce(length(regexp_replace(text, '[\x00-\x7F]|\p{L}|\p{N}', '', 'g')) / nullif(length(text), 0), 0), 9)::DOUBLE symbols FROM documents WHERE text IS NOT NULL")
def symbol_ratio(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.round(curation.symbol_ratio(F.col("text")), 9).alias("symbols"))


@query("""WITH l AS (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x: length(x))) n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, count(*) n_lines, round(sum(n)::BIGINT / count(*), 6)::DOUBLE mean, round(sum(n * n)::BIGINT / count(*) - (sum(n)::BIGINT / count(*)) * (sum(n)::BIGINT / count(*)), 3)::DOUBLE variance FROM l GROUP BY 1""")
def line_stats(spark, d):
    n, mean, variance = curation.line_stats(F.col("text"))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", n.alias("n_lines"), F.round(mean, 6).alias("mean"), F.round(variance, 3).alias("variance"))


@query(f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{_WS}+'), lambda x: x <> '') w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [] END g FROM w)
SELECT doc_id, round(CASE WHEN len(g) = 0 THEN 0 ELSE (len(g) - len(list_distinct(g))) / len(g) END, 9)::DOUBLE repeated FROM g""")
def ngram_repeat_ratio(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.round(curation.repeated_ngrams(F.col("text")), 9).alias("repeated"))


@query(r"""WITH x AS (SELECT doc_id, text, regexp_extract_all(text, 'https?://[^ \n\t]+|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}') hits FROM documents WHERE text IS NOT NULL)
SELECT doc_id, round(coalesce(list_sum(list_transform(hits, lambda h: length(h))) / nullif(length(text), 0), 0), 9)::DOUBLE links, round(coalesce(length(regexp_replace(text, '[^0-9]', '', 'g')) / nullif(length(text), 0), 0), 9)::DOUBLE digits FROM x""")
def url_email_digit_share(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.round(curation.link_share(t), 9).alias("links"), F.round(curation.digit_share(t), 9).alias("digits"))


@query("SELECT doc_id FROM documents WHERE length(text) >= CASE WHEN regexp_replace(lower(trim(lang)), '[-_].*', '') IN ('zh', 'zho', 'chi', 'chinese') THEN 200 WHEN regexp_replace(lower(trim(lang)), '[-_].*', '') IN ('en', 'eng', 'english') THEN 500 ELSE 0 END")
def min_length_by_lang(spark, d):
    return table(spark, d, "documents").where(curation.long_enough(F.col("lang"), F.length("text"))).select("doc_id")


@query(r"""SELECT doc_id, md5(regexp_replace(translate(text, '！＂＃＄％＆＇（）＊＋，－．／０１２３４５６７８９：；＜＝＞？＠ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ［＼］＾＿｀ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ｛｜｝～　',
 '!"#$%&''()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\]^_`abcdefghijklmnopqrstuvwxyz{|}~ '), '[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}\x{AD}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]', '', 'g')) digest FROM documents WHERE text IS NOT NULL""")
def plain_unicode_md5(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(text.plain_unicode(F.col("text"))).alias("digest"))


@query("""SELECT source, coalesce(lower(title) LIKE '%scan%' OR regexp_matches(lower(title), 'epson|hp scanjet|canon|fujitsu|kodak|brother|xerox|lexmark|kmc|kofax|ricoh|iris|capturedocument|paperport|simpleocr'), false)
 OR coalesce(regexp_matches(lower(doc_kind), 'scan|epson|canon|fujitsu|kodak|brother|xerox|lexmark|kmc|kofax|ricoh|iris|capturedocument|paperport|simpleocr'), false) scanner FROM sources""")
def known_scanner_flag(spark, d):
    return table(spark, d, "sources").select("source", routing.known_scanner(F.col("title"), F.col("doc_kind")).alias("scanner"))


# routing


_GUARD = """CASE WHEN router_error LIKE 'open_failed%' THEN 'open_failed' WHEN coalesce(is_encrypted, false) OR coalesce(needs_password, false) THEN 'encrypted'
 WHEN coalesce(features['num_pages_successfully_sampled'], 1.0) <= 0 THEN 'no_pages' WHEN router_error IS NOT NULL OR ocr_prob IS NULL OR ocr_prob::VARCHAR = 'nan' THEN 'classify_failed' END"""


@query(f"SELECT DISTINCT pdf_path, guard, CASE WHEN guard IS NOT NULL THEN 'deferred' WHEN ocr_prob < 0.5 THEN 'mupdf' ELSE 'pipeline' END routed FROM (SELECT *, {_GUARD} guard FROM router_decisions)")
def route_stage_a(spark, d):
    return routing.routed(table(spark, d, "router_decisions")).select("pdf_path", "guard", "routed").distinct()


@query(_RESULTS + "SELECT result_id, coalesce(stage_b_backend, backend) effective, coalesce(backend <> 'mupdf', false) needs_ocr, CASE WHEN coalesce(stage_b_backend, backend) IS NULL OR coalesce(stage_b_backend, backend) = 'mupdf' THEN 'text' WHEN coalesce(stage_b_backend, backend) = 'pipeline' AND layout_model IS NOT NULL THEN 'ocr' WHEN coalesce(stage_b_backend, backend) = 'vlm' AND layout_model IS NOT NULL THEN 'vlm' ELSE 'skip' END lane FROM r")
def route_effective_backend(spark, d):
    effective = routing.effective_backend(F.col("stage_b_backend"), F.col("backend"))
    return _results(spark, d).select("result_id", effective.alias("effective"), routing.needs_ocr(F.col("backend")).alias("needs_ocr"), routing.lane(effective, F.col("layout_model").isNotNull()).alias("lane"))


@query(_RESULTS + "SELECT result_id, substr(coalesce(router_error, error_class || ': ' || error_message), 1, 500) first_error FROM r WHERE router_error IS NOT NULL OR error_message IS NOT NULL")
def first_error_wins(spark, d):
    later = F.concat("error_class", F.lit(": "), "error_message")
    return _results(spark, d).where("router_error IS NOT NULL OR error_message IS NOT NULL").select("result_id", routing.first_error(F.col("router_error"), later).alias("first_error"))


@query(_RESULTS + f"SELECT result_id, {_KEPT} kept FROM r")
def kept_flag(spark, d):
    return _results(spark, d).select("result_id", routing.kept(F.col("error_class"), F.col("quality_score")).alias("kept"))


@query(_RESULTS + f"""SELECT r.pdf_path, r.sha256, r.extract_backend, md5(nullif(m.markdown, '')) markdown_md5, coalesce(markdown_chars, 0) markdown_chars, CASE WHEN ocr_prob::VARCHAR <> 'nan' THEN ocr_prob END ocr_prob, substr(error_message, 1, 500) error_message, {_KEPT} kept
 FROM r LEFT JOIN (SELECT sha256, backend, max(markdown) markdown FROM extracted_docs GROUP BY 1, 2) m ON r.sha256 = m.sha256 AND r.extract_backend = m.backend""")
def result_table(spark, d):
    rows = reports.result_table(table(spark, d, "doc_results"), table(spark, d, "extracted_docs"))
    return rows.select("pdf_path", "sha256", "extract_backend", F.md5("markdown").alias("markdown_md5"), "markdown_chars", "ocr_prob", "error_message", "kept")


@query(_RESULTS + "SELECT result_id, round(coalesce(wall_ms_router, 0) + coalesce(wall_ms_layout, 0) + coalesce(wall_ms_extract, 0) + coalesce(wall_ms_quality, 0), 3)::DOUBLE wall_ms_total FROM r")
def wall_total(spark, d):
    return _results(spark, d).select("result_id", F.round(routing.wall_total(*(F.col(f"wall_ms_{s}") for s in ("router", "layout", "extract", "quality"))), 3).alias("wall_ms_total"))


@query("SELECT DISTINCT r.pdf_path FROM router_decisions r JOIN doc_results d ON r.pdf_path = d.pdf_path WHERE d.backend = 'mupdf' AND coalesce(d.markdown_chars, 0) < 0.3 * 500 * r.num_pages")
def short_text_reroute(spark, d):
    few = routing.short_text(F.coalesce("markdown_chars", F.lit(0)), F.col("pages") * 500)
    pages = table(spark, d, "router_decisions").select("pdf_path", F.col("num_pages").alias("pages")).distinct()
    return table(spark, d, "doc_results").where("backend = 'mupdf'").join(pages, "pdf_path").where(few).select("pdf_path").distinct()


# features


@query("SELECT DISTINCT pdf_path, coalesce(features['num_pages_successfully_sampled'], 0.0) sampled, coalesce(features['page_level_char_counts_page1'], 0.0) chars_1, coalesce(features['page_level_char_counts_page8'], 0.0) chars_8, 124 n_columns FROM router_decisions")
def features_vector(spark, d):
    v = features.vectors(table(spark, d, "router_decisions"))
    n = len(features.vector_columns())
    return v.select("pdf_path", F.col("num_pages_successfully_sampled").alias("sampled"), F.col("page_level_char_counts_page1").alias("chars_1"), F.col("page_level_char_counts_page8").alias("chars_8"), F.lit(n).alias("n_columns")).distinct()


@query("SELECT DISTINCT pdf_path, e.key feature, e.value AS value FROM (SELECT pdf_path, unnest(map_entries(features)) e FROM router_decisions)")
def features_long(spark, d):
    return features.long_features(table(spark, d, "router_decisions")).distinct()


@query()
def features_page_sample(spark, d):
    return features.page_samples(table(spark, d, "router_decisions"))


# layout


@query(_SEGMENTS + "SELECT seg_id, row_number() OVER (PARTITION BY sha256, backend, page_index ORDER BY bbox.y0, bbox.x0, seg_index, seg_id) - 1 reading_order, 'p' || page_index || '_r' || (row_number() OVER (PARTITION BY sha256, backend, page_index ORDER BY bbox.y0, bbox.x0, seg_index, seg_id) - 1) region_id FROM s WHERE bbox IS NOT NULL")
def reading_order(spark, d):
    return layout.reading_order(_segments(spark, d)).select("seg_id", F.col("reading_order").cast("bigint").alias("reading_order"), "region_id")


@query(_SEGMENTS + "SELECT seg_id, round(greatest(0, least(1, bbox.x0)), 6)::DOUBLE x0, round(greatest(0, least(1, bbox.y1)), 6)::DOUBLE y1 FROM s WHERE bbox IS NOT NULL AND greatest(0, least(1, bbox.x1)) > greatest(0, least(1, bbox.x0)) AND greatest(0, least(1, bbox.y1)) > greatest(0, least(1, bbox.y0))")
def bbox_clamp(spark, d):
    return _segments(spark, d).select("seg_id", geometry.clamped(F.col("bbox")).alias("b")).where("b IS NOT NULL").select("seg_id", F.round("b.x0", 6).alias("x0"), F.round("b.y1", 6).alias("y1"))


@query(_SEGMENTS + "SELECT seg_id, coalesce(bbox.x0 >= 0 AND bbox.y0 >= 0 AND bbox.x1 <= 1 AND bbox.y1 <= 1 AND bbox.x0 <= 1 AND bbox.y0 <= 1 AND bbox.x1 >= bbox.x0 AND bbox.y1 >= bbox.y0, false) ok FROM s")
def bbox_valid(spark, d):
    return _segments(spark, d).select("seg_id", geometry.valid(F.col("bbox")).alias("ok"))


@query(_SEGMENTS + "SELECT seg_id FROM s WHERE (bbox.x1 - bbox.x0) * 612 * (200 / 72) < 10 OR (bbox.y1 - bbox.y0) * 792 * (200 / 72) < 10")
def tiny_region_filter(spark, d):
    return _segments(spark, d).where(geometry.tiny(F.col("bbox"), 612.0, 792.0)).select("seg_id")


@query(_SEGMENTS + "SELECT seg_id, trunc(bbox.x0 * 1700)::INTEGER crop_x0, trunc(bbox.y1 * 2200)::INTEGER crop_y1 FROM s WHERE bbox IS NOT NULL")
def crop_box(spark, d):
    c = geometry.crop(F.col("bbox"), F.lit(1700), F.lit(2200))
    return _segments(spark, d).where("bbox IS NOT NULL").select("seg_id", c[0].alias("crop_x0"), c[3].alias("crop_y1"))


_STAGE_B = _SEGMENTS + "SELECT sha256, backend, count(DISTINCT page_index) num_pages, count(*) num_regions, count(*) FILTER (WHERE seg_type IN ('table', 'formula')) num_complex_regions, bool_or(coalesce(seg_type IN ('table', 'formula'), false)) has_complex_content, CASE WHEN bool_or(coalesce(seg_type IN ('table', 'formula'), false)) THEN '%s' ELSE 'pipeline' END stage_b FROM s GROUP BY 1, 2"


@query(_STAGE_B % "deferred")
def stage_b(spark, d):
    return routing.stage_b_rows(_segments(spark, d))


@query(_STAGE_B % "vlm")
def stage_b_vlm(spark, d):
    return routing.stage_b_rows(_segments(spark, d), vlm_enabled=True)


@query(_SEGMENTS + "SELECT seg_id FROM s WHERE (sha256, backend, page_index) IN (SELECT (sha256, backend, page_index) FROM s WHERE seg_type IN ('table', 'formula'))")
def complex_pages_only(spark, d):
    return layout.complex_pages(_segments(spark, d)).select("seg_id")


@query(_SEGMENTS + f"""SELECT sha256, backend, count(*) segment_count, coalesce(sum(length(content)), 0)::BIGINT char_count, count(DISTINCT page_index) page_count, count(*) FILTER (WHERE seg_type = 'text') n_text, count(*) FILTER (WHERE seg_type = 'image') n_image,
 count(*) FILTER (WHERE seg_type = 'table') n_table, count(*) FILTER (WHERE seg_type = 'formula') n_formula, count(*) FILTER (WHERE {_STRIP % "coalesce(content, '')"} = '') region_failures,
 coalesce(string_agg(DISTINCT page_index::VARCHAR, ',' ORDER BY page_index::VARCHAR) FILTER (WHERE seg_type IN ('table', 'formula')), '') complex_pages FROM s GROUP BY 1, 2""".replace("string_agg(DISTINCT page_index::VARCHAR, ',' ORDER BY page_index::VARCHAR) FILTER (WHERE seg_type IN ('table', 'formula'))", "array_to_string(list_sort(list_distinct(list(page_index) FILTER (WHERE seg_type IN ('table', 'formula')))), ',')"))
def parser_stats(spark, d):
    return layout.parser_stats(_segments(spark, d))


@query(_SEGMENTS + "SELECT sha256, backend, count(*) n_excerpts, sum(length(substr(coalesce(content, ''), 1, 200)))::BIGINT n_chars FROM s WHERE backend = 'vlm' GROUP BY 1, 2")
def segments_excerpt(spark, d):
    rows = layout.excerpt(_segments(spark, d).where("backend = 'vlm'"))
    from docloom.schema import EXCERPT

    back = rows.withColumn("e", F.from_json("segments_excerpt", EXCERPT))
    total = F.aggregate("e", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x["content"]))
    return back.select("sha256", "backend", F.size("e").cast("bigint").alias("n_excerpts"), total.alias("n_chars"))


@query(_SEGMENTS + "SELECT seg_id, page_index, seg_type, round(bbox.x0, 4) x0, round(bbox.y0, 4) y0, round(bbox.x1, 4) x1, round(bbox.y1, 4) y1, length(coalesce(content, '')) chars, replace(substr(coalesce(content, ''), 1, 120), chr(10), ' ') preview FROM s")
def segment_preview(spark, d):
    return layout.preview_rows(_segments(spark, d))


@query(_SEGMENTS + "SELECT seg_type, CASE seg_type WHEN 'formula' THEN 'equation' ELSE seg_type END vision_type, count(*) n, count(*) FILTER (WHERE seg_type = 'image' AND content IS NOT NULL) n_placeholders FROM s GROUP BY ALL")
def region_type_counts(spark, d):
    vision = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in layout.VISION_TYPES.items() for x in kv)), F.col("seg_type")), F.col("seg_type"))
    shown = (F.col("seg_type") == "image") & F.col("content").isNotNull()
    return _segments(spark, d).groupBy("seg_type", vision.alias("vision_type")).agg(F.count("*").alias("n"), F.count_if(shown).alias("n_placeholders"))


# summaries


@query(_RESULTS + f"""SELECT count(*) num_pdfs, count(*) FILTER (WHERE error_class IS NULL AND sha256 IS NOT NULL) num_extracted, count(*) FILTER (WHERE error_class IS NULL AND markdown_chars > 0) num_with_markdown,
 count(*) FILTER (WHERE quality_score::VARCHAR <> 'nan') num_scored, count(error_class) num_errors, count(*) FILTER (WHERE {_KEPT}) num_kept,
 round(sum(quality_score::DECIMAL(28,10)) FILTER (WHERE quality_score::VARCHAR <> 'nan'), 6)::DOUBLE sum_quality, round((sum(quality_score::DECIMAL(28,10)) FILTER (WHERE quality_score::VARCHAR <> 'nan'))::DOUBLE / count(*) FILTER (WHERE quality_score::VARCHAR <> 'nan'), 6) avg_quality,
 (SELECT '{{' || coalesce(string_agg('"' || b || '":' || n, ',' ORDER BY b), '') || '}}' FROM (SELECT coalesce(extract_backend, backend) b, count(*) n FROM r WHERE backend IS NOT NULL GROUP BY 1)) by_backend,
 (SELECT '{{' || coalesce(string_agg('"' || b || '":' || n, ',' ORDER BY b), '') || '}}' FROM (SELECT stage_b_backend b, count(*) n FROM r WHERE b IS NOT NULL GROUP BY 1)) by_stage_b FROM r""".replace("quality_score::DECIMAL(28,10)", "(CASE WHEN quality_score::VARCHAR <> 'nan' THEN quality_score END)::DECIMAL(28,10)"))
def run_summary(spark, d):
    return reports.run_summary(table(spark, d, "doc_results"))


@query(_RESULTS + "SELECT coalesce(extract_backend, backend) by_backend, count(*) n FROM r WHERE backend IS NOT NULL GROUP BY 1")
def by_backend(spark, d):
    return reports.counts_by(table(spark, d, "doc_results"), F.when(F.col("backend").isNotNull(), F.coalesce("extract_backend", "backend")), "by_backend", skip_null=True)


@query(_RESULTS + "SELECT stage_b_backend by_stage_b, count(*) n FROM r WHERE stage_b_backend IS NOT NULL GROUP BY 1")
def by_stage_b(spark, d):
    return reports.counts_by(table(spark, d, "doc_results"), F.col("stage_b_backend"), "by_stage_b", skip_null=True)


@query(_RESULTS + """SELECT dimension, v AS value, count(*) n FROM (SELECT 'backend' dimension, coalesce(extract_backend, 'NULL') v FROM r UNION ALL SELECT 'stage_b', stage_b_backend FROM r
 UNION ALL SELECT 'source', CASE WHEN contains(pdf_path, 'omnidocbench_100') THEN 'omnidocbench_100' WHEN contains(pdf_path, 'olmocr_bench_50') THEN 'olmocr_bench_50' ELSE 'other' END FROM r UNION ALL SELECT 'error', error_class FROM r) WHERE v IS NOT NULL GROUP BY ALL""")
def dist_backend_source_error(spark, d):
    return reports.distributions(table(spark, d, "doc_results"))


_HIST = _RESULTS + """SELECT b.bin::INTEGER bin, round(b.bin * %(hi)s / 20, 6)::DOUBLE edge, count(v) n FROM range(20) b(bin) LEFT JOIN
 (SELECT greatest(0, least(19, trunc(%(c)s / %(hi)s * 20)))::INTEGER v FROM r WHERE %(c)s IS NOT NULL AND %(c)s::VARCHAR <> 'nan') ON v = b.bin GROUP BY b.bin"""


@query(_HIST % {"c": "ocr_prob", "hi": "1.0"})
def hist_ocr_prob(spark, d):
    return reports.histogram(_results(spark, d), "ocr_prob", 0.0, 1.0)


@query(_HIST % {"c": "quality_score", "hi": "3.0"})
def hist_quality(spark, d):
    return reports.histogram(_results(spark, d), "quality_score", 0.0, 3.0)


@query(_RESULTS + """, s AS (SELECT coalesce(markdown_chars, 0)::BIGINT v, row_number() OVER (ORDER BY coalesce(markdown_chars, 0)) - 1 i, count(*) OVER () n FROM r)
SELECT min(v) "min", max(v) FILTER (WHERE i = n // 4) p25, max(v) FILTER (WHERE i = n // 2) p50, max(v) FILTER (WHERE i = 3 * n // 4) p75, max(v) "max" FROM s""")
def percentiles_chars(spark, d):
    return reports.percentiles(_results(spark, d).select(F.coalesce("markdown_chars", F.lit(0)).alias("c")), "c")


@query(_RESULTS + f"SELECT result_id, coalesce(CASE WHEN quality_score::VARCHAR <> 'nan' THEN quality_score END, -1.0) sort_score FROM r WHERE {_KEPT} AND extract_backend = 'mupdf' AND contains(lower(regexp_extract(pdf_path, '[^/]*$')), 'f0000')")
def dashboard_filter_sort_search(spark, d):
    return reports.dashboard(table(spark, d, "doc_results"), kept_only=True, backend="mupdf", search="F0000").select("result_id", "sort_score")


@query(_RESULTS + f"""SELECT result_id, CASE WHEN coalesce(sha256, '') <> '' THEN substr(sha256, 1, 8) ELSE 'r' || lpad(result_id::VARCHAR, greatest(3, length(result_id::VARCHAR))::INTEGER, '0') END id, CASE WHEN coalesce(pdf_path, '') <> '' THEN regexp_extract(pdf_path, '[^/]*$') ELSE 'unknown.pdf' END pdf_basename,
 CASE WHEN contains(pdf_path, 'omnidocbench_100') THEN 'omnidocbench_100' WHEN contains(pdf_path, 'olmocr_bench_50') THEN 'olmocr_bench_50' ELSE 'other' END path_source,
 CASE WHEN contains(pdf_path, 'omnidocbench_100') THEN CASE WHEN list_contains(string_split(pdf_path, '/'), 'omnidocbench_100') THEN 'omnidoc__' || regexp_replace(regexp_extract(pdf_path, '[^/]*$'), '[.][^.]*$', '') END
  WHEN list_contains(string_split(pdf_path, '/'), 'olmocr_bench_50') THEN 'olmocr__' || string_split(pdf_path, '/')[list_position(string_split(pdf_path, '/'), 'olmocr_bench_50') + 2] || '__' || regexp_replace(regexp_extract(pdf_path, '[^/]*$'), '[.][^.]*$', '') END preview_key,
 coalesce(num_pages, 0) num_pages, coalesce(is_form, false) is_form, coalesce(markdown_chars, 0) markdown_chars, CASE WHEN ocr_prob::VARCHAR <> 'nan' THEN ocr_prob END ocr_prob, {_KEPT} kept FROM r""")
def viz_rows(spark, d):
    return reports.view_rows(table(spark, d, "doc_results"))


@query()
def viz_bundle(spark, d):
    return reports.view_bundle(table(spark, d, "doc_results"))


@query(_RESULTS + "SELECT ingested_at::DATE \"day\", coalesce(backend, 'NULL') backend, count(*) n, count(error_class) failures, count(*) FILTER (WHERE stage_b_backend <> backend) fallbacks, round(count(error_class) / count(*), 6) failure_rate FROM r WHERE ingested_at IS NOT NULL GROUP BY 1, 2")
def daily_metrics(spark, d):
    return reports.daily(table(spark, d, "doc_results"))


_RUN = "SELECT pdf_path, max(backend) backend, max(CASE WHEN ocr_prob::VARCHAR <> 'nan' THEN ocr_prob END) prob FROM doc_results WHERE pdf_path IS NOT NULL AND started_at %s 1718000000 GROUP BY 1"


@query(f"""SELECT coalesce(a.pdf_path, b.pdf_path) pdf_path, CASE WHEN a.pdf_path IS NULL THEN 'added' WHEN b.pdf_path IS NULL THEN 'removed' WHEN a.backend IS DISTINCT FROM b.backend THEN 'backend'
 WHEN coalesce(abs(a.prob - b.prob) > 1e-6, (a.prob IS NULL) <> (b.prob IS NULL)) THEN 'ocr_prob' END change FROM ({_RUN % '<'}) a FULL OUTER JOIN ({_RUN % '>='}) b ON a.pdf_path = b.pdf_path WHERE change IS NOT NULL""")
def run_diff(spark, d):
    def run(after: bool) -> DataFrame:
        rows = table(spark, d, "doc_results").where("pdf_path IS NOT NULL").where(F.col("started_at") >= 1718000000 if after else F.col("started_at") < 1718000000)
        return rows.groupBy("pdf_path").agg(F.max("backend").alias("backend"), F.max(text.known(F.col("ocr_prob"))).alias("ocr_prob"))

    return reports.run_diff(run(False), run(True))


@query(_RESULTS + """, lay AS (SELECT sha256, sum(n)::BIGINT n_regions, bool_or(hard) has_complex FROM (SELECT sha256, count(DISTINCT seg_id) n, bool_or(coalesce(seg_type IN ('table', 'formula'), false)) hard FROM segments GROUP BY sha256, backend) GROUP BY 1)
SELECT result_id, lay.n_regions, lay.has_complex FROM r LEFT JOIN lay ON r.sha256 = lay.sha256""")
def results_with_layout(spark, d):
    lay = routing.stage_b_rows(_segments(spark, d)).groupBy("sha256").agg(F.sum("num_regions").alias("n_regions"), F.bool_or("has_complex_content").alias("has_complex"))
    return _results(spark, d).join(lay, "sha256", "left").select("result_id", "n_regions", "has_complex")


@query(_RESULTS + "SELECT result_id, title, priority FROM r LEFT JOIN sources USING (source)")
def results_with_sources(spark, d):
    return _results(spark, d).join(table(spark, d, "sources").select("source", "title", "priority"), "source", "left").select("result_id", "title", "priority")


# review


_LATEST = """(SELECT * FROM badcases WHERE sha256 IS NOT NULL AND sha256 <> '' QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY coalesce(flagged_at, '') DESC, coalesce(stage, '') DESC, coalesce(note, '') DESC, coalesce(flagged_by, '') DESC, coalesce(is_bad::VARCHAR, '') DESC) = 1)"""


@query(f"SELECT sha256, is_bad, stage, note, flagged_at, flagged_by FROM {_LATEST}")
def flags_latest(spark, d):
    return review.latest_flags(table(spark, d, "badcases")).select("sha256", "is_bad", "stage", "note", "flagged_at", "flagged_by")


@query(f"SELECT sha256, stage FROM {_LATEST} WHERE is_bad")
def flags_active(spark, d):
    return review.active_flags(table(spark, d, "badcases")).select("sha256", "stage")


@query(_RESULTS + f"SELECT result_id FROM r WHERE sha256 IN (SELECT sha256 FROM {_LATEST} WHERE is_bad)")
def flags_semi(spark, d):
    return _results(spark, d).join(review.active_flags(table(spark, d, "badcases")), "sha256", "left_semi").select("result_id")


@query(_RESULTS + f"SELECT result_id FROM r WHERE sha256 IS NULL OR sha256 NOT IN (SELECT sha256 FROM {_LATEST} WHERE is_bad)")
def flags_anti(spark, d):
    return _results(spark, d).join(review.active_flags(table(spark, d, "badcases")), "sha256", "left_anti").select("result_id")


@query("SELECT stage, count(*) n, count(*) FILTER (WHERE length(note) > 0) n_noted FROM (SELECT DISTINCT sha256, flagged_at, flagged_by, is_bad, note, coalesce(stage, 'overall') stage FROM badcases WHERE sha256 <> '' AND (stage IS NULL OR stage IN ('router', 'layout', 'extract', 'quality', 'overall'))) GROUP BY 1")
def flags_valid_by_stage(spark, d):
    ok, stage, _ = review.valid_flag(F.col("sha256"), F.col("stage"), F.col("note"))
    rows = table(spark, d, "badcases").where(ok).select("sha256", "flagged_at", "flagged_by", "is_bad", "note", stage.alias("stage")).distinct()
    return rows.groupBy("stage").agg(F.count("*").alias("n"), F.count_if(F.length("note") > 0).alias("n_noted"))


@query("SELECT tag, count(*) n FROM (SELECT unnest(tags) tag FROM badcases) WHERE tag IS NOT NULL GROUP BY 1")
def flag_tags(spark, d):
    return table(spark, d, "badcases").select(F.explode("tags").alias("tag")).where("tag IS NOT NULL").groupBy("tag").agg(F.count("*").alias("n"))


@query(f"SELECT sha256, is_bad, stage FROM {_LATEST}")
def flags_json_log(spark, d):
    from docloom.schema import BAD_CASES

    lines = table(spark, d, "badcases").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    return review.latest_flags(review.parsed_log(lines, BAD_CASES)).select("sha256", "is_bad", "stage")


@query(f"SELECT sha256, is_bad, stage FROM {_LATEST}")
def flags_stream_latest(spark, d):
    schema = table(spark, d, "badcases").schema
    path = f"{d}/badcases.parquet"
    stream = streams.flags_stream(spark, path if is_folder(spark, path) else path + "*", schema)
    return streams.drained(stream, "flags_stream_latest").select("sha256", "is_bad", "stage")


@query("""WITH b AS (SELECT sha256, min(backend) "label" FROM router_decisions WHERE sha256 IS NOT NULL GROUP BY 1),
u AS (SELECT sha256, max(stage) "label" FROM badcases WHERE sha256 <> '' AND stage IS NOT NULL GROUP BY 1)
SELECT b.sha256, coalesce(u."label", b."label") "label", u.sha256 IS NOT NULL changed FROM b LEFT JOIN u ON b.sha256 = u.sha256""")
def labels_merge(spark, d):
    base = table(spark, d, "router_decisions").where("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("backend").alias("label")).withColumn("annotated_at", F.lit(None).cast("string"))
    updates = table(spark, d, "badcases").select("sha256", F.create_map(F.lit("label"), F.col("stage")).alias("set"), F.col("stage").alias("position"))
    merged = review.merged_labels(base, updates, "sha256", ["label"], "position", F.lit("now"))
    return merged.select("sha256", "label", F.col("annotated_at").isNotNull().alias("changed"))


# curation


@query(f"SELECT md5({_NORM}) content_md5, min(doc_id) doc_id, count(DISTINCT doc_id) copies FROM documents WHERE text IS NOT NULL GROUP BY 1")
def dedup_normalized(spark, d):
    return curation.first_of_same(table(spark, d, "documents"), "doc_id", "text")


@query()
def near_duplicate_classes(spark, d):
    return neardup.classes(table(spark, d, "documents"))


_LUHN = "list_sum(list_transform(generate_series(1, len(n)), lambda i: CASE WHEN (len(n) - i) % 2 = 0 THEN n[i]::INTEGER WHEN n[i]::INTEGER > 4 THEN n[i]::INTEGER * 2 - 9 ELSE n[i]::INTEGER * 2 END)) % 10 = 0"


def _numbers(column: str) -> str:
    return f"list_filter({_found(curation.PII['card'], column)}, lambda n: {_LUHN})"


def _found(pattern: str, column: str = "text") -> str:
    return f"regexp_extract_all({column}, '{pattern}')"


def _redaction(column: str) -> str:
    for kind, pattern in curation.PII.items():
        if kind == "card":
            column = f"(SELECT list_reduce(list_prepend(x, list_distinct({_numbers('x')})), lambda a, n: replace(a, n, '⟨PII:card⟩')) FROM (SELECT {column} x))"
        else:
            column = f"regexp_replace({column}, '{pattern}', '⟨PII:{kind}⟩', 'g')"
    return column


@query(f"SELECT doc_id, md5({_redaction('text')}) digest FROM documents WHERE text IS NOT NULL")
def pii_redact(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(curation.redacted(F.col("text"))).alias("digest"))


_HITS = " UNION ALL ".join(f"SELECT doc_id, '{k}' kind, unnest({_numbers('text') if k == 'card' else _found(p)}) hit FROM documents" for k, p in curation.PII.items())


@query(f"SELECT doc_id, kind, sha256(hit) sha, count(*) n FROM ({_HITS}) GROUP BY ALL")
def pii_audit_counts(spark, d):
    return curation.pii_audit(table(spark, d, "documents"), "doc_id", "text")


@query("SELECT doc_id FROM documents WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 1000 = 0")
def hash_sample_1_in_1000(spark, d):
    return curation.hash_sample(table(spark, d, "documents"), "doc_id").select("doc_id")


@query(_RESULTS + "SELECT source, CASE WHEN quality_score IS NULL OR quality_score::VARCHAR = 'nan' THEN 'none' WHEN quality_score < 1.0 THEN 'low' WHEN quality_score < 2.0 THEN 'mid' ELSE 'high' END quality_bucket, count(*) n FROM r GROUP BY ALL")
def bucketed_layout(spark, d):
    return _results(spark, d).groupBy("source", curation.quality_bucket(F.col("quality_score")).alias("quality_bucket")).agg(F.count("*").alias("n"))


# set operations, plans and providers


@query(_RESULTS + "SELECT sha256, extract_backend FROM r WHERE extract_backend = 'mupdf' UNION ALL SELECT sha256, extract_backend FROM r WHERE extract_backend = 'pipeline' UNION ALL SELECT sha256, extract_backend FROM r WHERE extract_backend = 'vlm'")
def union_lanes(spark, d):
    return _results(spark, d).where(F.col("extract_backend").isin("mupdf", "pipeline", "vlm")).select("sha256", "extract_backend")


@query("SELECT DISTINCT sha256, backend FROM extracted_docs EXCEPT SELECT sha256, extract_backend FROM doc_results WHERE error_class IS NULL")
def extracted_without_result(spark, d):
    done = table(spark, d, "doc_results").where("error_class IS NULL").select("sha256", F.col("extract_backend").alias("backend"))
    return table(spark, d, "extracted_docs").select("sha256", "backend").subtract(done)


@query("SELECT sha256 FROM router_decisions WHERE sha256 IS NOT NULL AND sha256 NOT IN (SELECT sha256 FROM extracted_docs WHERE sha256 IS NOT NULL) GROUP BY 1")
def resume_remaining(spark, d):
    keys = table(spark, d, "router_decisions").where("sha256 IS NOT NULL").select("sha256").distinct()
    return streams.remaining(keys, table(spark, d, "extracted_docs").where("sha256 IS NOT NULL"))


_RUN_SQL = f"""WITH d AS (SELECT *, {_GUARD} guard FROM router_decisions QUALIFY row_number() OVER (PARTITION BY pdf_path ORDER BY decided_at DESC NULLS LAST, sha256 DESC NULLS LAST) = 1),
s AS (SELECT * FROM segments WHERE sha256 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sha256, backend, seg_index) = 1),
lay AS (SELECT sha256, count(*) n, bool_or(coalesce(seg_type IN ('table', 'formula'), false)) hard FROM s WHERE backend = 'pipeline' OR backend = 'vlm' AND sha256 NOT IN (SELECT sha256 FROM s WHERE backend = 'pipeline') GROUP BY 1),
r AS (SELECT d.pdf_path, d.sha256, ocr_prob, guard, coalesce(router_error, guard) error_router, CASE WHEN guard IS NOT NULL THEN 'deferred' WHEN ocr_prob < 0.5 THEN 'mupdf' ELSE 'pipeline' END backend, lay.n, lay.hard, num_pages, is_form, garbled_text_ratio, is_encrypted FROM d LEFT JOIN lay USING (sha256)),
e AS (SELECT *, CASE WHEN backend <> 'mupdf' AND guard IS NULL AND n IS NOT NULL THEN CASE WHEN hard THEN 'deferred' ELSE 'pipeline' END END stage_b FROM r),
f AS (SELECT *, coalesce(stage_b, backend) extract_backend, guard IS NULL AND (coalesce(stage_b, backend) = 'mupdf' OR coalesce(stage_b, backend) = 'pipeline' AND n IS NOT NULL) runs FROM e),
m AS (SELECT sha256, backend, {_STRIP % "coalesce(string_agg(c, chr(10) || chr(10) ORDER BY seg_index) FILTER (WHERE c <> ''), '')"} || chr(10) md, count(*) FILTER (WHERE c = '') failures FROM (SELECT *, {_STRIP % "coalesce(content, '')"} c FROM s) GROUP BY 1, 2),
g AS (SELECT f.*, m.md, m.failures, runs AND m.md IS NULL no_segments FROM f LEFT JOIN m ON f.sha256 = m.sha256 AND f.extract_backend = m.backend AND f.runs),
q AS (SELECT *, substr({_STRIP % "coalesce(md, '')"}, 1, 10000) t FROM g),
w AS (SELECT *, CASE WHEN md IS NULL THEN NULL WHEN t = '' THEN 0.0 ELSE round(greatest(0.0, least(3.0, 1.5 * greatest(0.0, least(1.0, coalesce(length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) / nullif(length(t), 0), 0))) + 1.5 * greatest(0.0, least(1.0, coalesce(len(regexp_extract_all(t, '[.!?。？！]')) * 12 / nullif(len(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+')), 0), 0))))), 4) END::DOUBLE score FROM q)
SELECT pdf_path, sha256, backend, stage_b stage_b_backend, CASE WHEN ocr_prob::VARCHAR <> 'nan' THEN ocr_prob END ocr_prob, num_pages, is_form, garbled_text_ratio, is_encrypted, CASE WHEN stage_b IS NOT NULL THEN 'rules@1' END layout_model, n::INTEGER layout_num_regions, hard layout_has_complex, extract_backend,
 md5(md) markdown_md5, coalesce(length(md), 0) markdown_chars, score quality_score, CASE WHEN score IS NOT NULL THEN 'rules@1' END quality_model, CASE WHEN guard IS NOT NULL THEN 'router' WHEN no_segments THEN 'extract_' || extract_backend END error_class,
 CASE WHEN guard IS NOT NULL THEN substr(error_router, 1, 500) WHEN no_segments THEN 'no segments' END error_message, failures::INTEGER region_failures, coalesce(guard IS NULL AND NOT no_segments AND score >= 2.0, false) kept FROM w"""


@query(_RUN_SQL)
def pipeline_run(spark, d):
    rows = pipeline.run(table(spark, d, "router_decisions"), table(spark, d, "segments"))
    return rows.withColumn("markdown_md5", F.md5("markdown")).drop("markdown", "segments_excerpt", "wall_ms_total")


@query()
def pipeline_run_vlm(spark, d):
    return pipeline.run(table(spark, d, "router_decisions"), table(spark, d, "segments"), config.build({}, vlm=True))


def queries() -> dict[str, Query]:
    from docloom import surfaces  # noqa: F401  (adds its queries)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from docloom import surfaces  # noqa: F401

    return dict(_SQL)
