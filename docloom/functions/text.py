"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.split() and str.strip() call white space, as a character class body.
SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The parse errors of a scorer's reply.
REPLY_ERRORS = ("empty response", "no JSON object in reply", "json parse failed", "reply is not a JSON object", "score not numeric")


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def normalize_text(c: Column) -> Column:
    """Paragraphs (between double line feeds) with white space collapsed, blank ones dropped."""
    flat = F.transform(F.split(c, "\n\n"), lambda p: strip(F.regexp_replace(p, f"[{SPACE}]+", " ")))
    return F.array_join(F.filter(flat, lambda p: p != ""), "\n\n")


def merge_markdown(contents: Column) -> Column:
    """Non-empty contents joined by blank lines, stripped, with a final line feed; nothing to join gives a line feed."""
    kept = F.filter(contents, lambda x: x.isNotNull() & (x != ""))
    return F.concat(strip(F.array_join(kept, "\n\n")), F.lit("\n"))


def region_id(page: Column, order: Column) -> Column:
    return F.format_string("p%d_r%d", page, order)


def slug(c: Column) -> Column:
    """A model tag as part of a file name: letters, digits and ``._-@`` stay, all else becomes an underscore."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}._\-@]", "_")


def shard(sha: Column) -> Column:
    """Shard 00 to ff of a content key."""
    return F.substring(sha, 1, 2)


def cache_path(sha: Column, model: Column) -> Column:
    """Place of a layout in a cache, NULL for keys of fewer than four characters."""
    return F.when(F.length(sha) >= 4, F.concat_ws("/", F.substring(sha, 1, 2), F.substring(sha, 3, 2), F.concat(sha, F.lit("."), slug(model), F.lit(".json"))))


def count_of(c: Column, part: str) -> Column:
    """How often ``part`` occurs, without overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("bigint")


def garbled_ratio(c: Column) -> Column:
    """Share of U+FFFD among the characters; 0 for none."""
    return F.coalesce(F.try_divide(count_of(c, "�").cast("double"), F.length(c).cast("double")), F.lit(0.0))


def safe_ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    """a / b, ``empty`` where b is zero or either is NULL."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def known(c: Column) -> Column:
    """A number, NULL where it is NaN."""
    return F.when(~F.isnan(c), c)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def path_source(path: Column) -> Column:
    """Benchmark set that a path belongs to."""
    found = F.lit("other")
    for name in ("olmocr_bench_50", "omnidocbench_100"):
        found = F.when(path.contains(name), F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit("other"))


def preview_key(path: Column) -> Column:
    """Key of a path's preview picture; NULL where the path has not the parts that make it."""
    parts = F.split(path, "/")
    at = F.array_position(parts, "olmocr_bench_50").cast("int")
    category = F.when(at > 0, F.try_element_at(parts, at + 2))
    olm = F.when(category.isNotNull() & (at + 2 <= F.size(parts)), F.concat(F.lit("olmocr__"), category, F.lit("__"), stem(path)))
    omni = F.when(F.array_contains(parts, "omnidocbench_100"), F.concat(F.lit("omnidoc__"), stem(path)))
    return F.when(path_source(path) == "olmocr_bench_50", olm).when(path.contains("omnidocbench_100"), omni)


def excerpt_json(segments: Column) -> Column:
    """An array of excerpt structs as JSON text, NULL when empty."""
    return F.when(F.size(segments) > 0, F.to_json(segments))


def excerpt_rows(text: Column, schema: str, most: int = 200) -> Column:
    """The excerpt of JSON text, contents cut again; NULL where the text is no array of objects."""
    rows = F.from_json(text, schema)
    return F.transform(F.filter(rows, lambda s: s.isNotNull()), lambda s: s.withField("content", F.substring(F.coalesce(s["content"], F.lit("")), 1, most)))


def parse_reply(raw: Column) -> Column:
    """A scorer's reply as struct<score, reason, error>.

    Code fences go, then the whole must be JSON, else the part from the first { to the last }. The score is clamped to
    [0, 3] and 0 with an error text otherwise; reasons are cut at 500 characters.
    """
    text = strip(F.coalesce(raw, F.lit("")))
    bare = strip(F.regexp_replace(F.regexp_replace(text, "^`+|`+$", ""), "^(?i)json", ""))
    body = F.when(text.startswith("```"), bare).otherwise(text)
    whole = F.try_parse_json(body)
    part = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    value = F.coalesce(whole, F.try_parse_json(F.nullif(part, F.lit(""))))
    kind = F.schema_of_variant(value)
    score = F.coalesce(F.try_variant_get(value, "$.score", "double"), F.try_to_number(F.try_variant_get(value, "$.score", "string"), F.lit("999999.999999")).cast("double"))
    reason = F.substring(F.coalesce(F.try_variant_get(value, "$.reason", "string"), F.lit("")), 1, 500)
    shown = F.coalesce(F.try_variant_get(value, "$.score", "string"), F.lit("None"))
    error = (
        F.when(text == "", REPLY_ERRORS[0])
        .when(whole.isNull() & (part == ""), REPLY_ERRORS[1])
        .when(value.isNull(), REPLY_ERRORS[2])
        .when(~kind.startswith("OBJECT"), REPLY_ERRORS[3])
        .when(score.isNull(), F.concat(F.lit(REPLY_ERRORS[4] + ": "), shown))
    )
    return F.struct(F.when(error.isNull(), clamp(score, 0.0, 3.0)).otherwise(F.lit(0.0)).alias("score"), F.when(kind.startswith("OBJECT"), reason).otherwise(F.lit("")).alias("reason"), error.alias("error"))


def data_url(content: Column, path: Column) -> Column:
    """A picture's bytes as a data URL by its suffix; PNG if unknown."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    mime = F.when(suffix.isin("jpg", "jpeg"), "image/jpeg").when(suffix == "webp", "image/webp").when(suffix == "gif", "image/gif").otherwise("image/png")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content))


def size_text(n: Column) -> Column:
    """Bytes in the largest unit below which less than one would stand."""
    out = F.format_string("%.1f B", n.cast("double"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024**power, F.format_string("%.1f " + unit, n / float(1024**power))).otherwise(out)
    return out


def plain_unicode(c: Column) -> Column:
    """Full-width ASCII made narrow, control and zero-width characters removed; composition is left as it is."""
    wide = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
    narrow = "".join(chr(0x21 + i) for i in range(94)) + " "
    return F.regexp_replace(F.translate(c, wide, narrow), r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}\x{AD}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]", "")


def utc_text(seconds: Column) -> Column:
    """Epoch seconds as ISO text in UTC, whatever the session's zone; fractions are cut."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(F.floor(seconds)), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def request(url: Column, parameter: str) -> tuple[Column, Column]:
    """(path without its slash, value of a query parameter) of a request, unquoted."""
    path = F.try_url_decode(F.regexp_replace(F.parse_url(url, F.lit("PATH")), "^/", ""))
    return path, F.try_url_decode(F.parse_url(url, F.lit("QUERY"), F.lit(parameter)))


def incremented(counts: Column, key: Column, by: int = 1) -> Column:
    """A map of counts with a key's raised, from 0 where it has none."""
    n = F.coalesce(F.try_element_at(counts, key), F.lit(0)) + by
    return F.map_concat(F.map_filter(counts, lambda k, _: k != key), F.create_map(key, n))
