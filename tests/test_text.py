import pytest
from pyspark.sql import functions as F

from docloom.functions import text


def one(spark, c, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(c.alias("out")).first()
    return row.out


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("  a \n b\t c  ", "a b c"), ("p1 x\n\n  \n\n p2 　y \n\n\n z", "p1 x\n\np2 y\n\nz"), ("\x1ca\x1db", "a b"), ("", ""), ("\n\n", ""), (None, None)],
)
def test_normalize(spark, given, wanted):
    assert one(spark, text.normalize_text(F.col("t").cast("string")), t=given) == wanted


def test_merge_markdown(spark):
    merged = lambda xs: spark.createDataFrame([(xs,)], "x array<string>").select(text.merge_markdown(F.col("x"))).first()[0]
    assert merged([" A", "B ", ""]) == "A\n\nB\n"
    assert merged([""]) == "\n"
    assert merged([None, "x"]) == "x\n"
    assert merged([]) == "\n"


@pytest.mark.parametrize(
    ("reply", "score", "error"),
    [
        ('{"score": 2,"reason":"ok"}', 2.0, None),
        ('```json\n{"score": 5}\n```', 3.0, None),
        ('Sure: {"score": "1.5"} done', 1.5, None),
        ("no json", 0.0, "no JSON object in reply"),
        ('{"score": null}', 0.0, "score not numeric: None"),
        ("[1]", 0.0, "reply is not a JSON object"),
        ("", 0.0, "empty response"),
        (None, 0.0, "empty response"),
        ("{broken}", 0.0, "json parse failed"),
    ],
)
def test_parse_reply(spark, reply, score, error):
    out = spark.createDataFrame([(reply,)], "r string").select(text.parse_reply(F.col("r")).alias("o")).first().o
    assert (out.score, out.error) == (score, error)


def test_paths(spark):
    rows = ["x/olmocr_bench_50/pdfs/tables/f1.pdf", "x/omnidocbench_100/pdfs/f2.pdf", "z/f3.pdf", "olmocr_bench_50/f.pdf", None]
    df = spark.createDataFrame([(r,) for r in rows], "p string").select(text.path_source(F.col("p")), text.preview_key(F.col("p")))
    assert [tuple(r) for r in df.collect()] == [("olmocr_bench_50", "olmocr__tables__f1"), ("omnidocbench_100", "omnidoc__f2"), ("other", None), ("olmocr_bench_50", None), ("other", None)]


def test_small_functions(spark):
    assert one(spark, text.slug(F.col("t")), t="a/b c@1.0") == "a_b_c@1.0"
    assert one(spark, text.region_id(F.col("a"), F.col("b")), a=3, b=0) == "p3_r0"
    assert one(spark, text.cache_path(F.col("t"), F.lit("m@1")), t="abc") is None
    assert one(spark, text.cache_path(F.col("t"), F.lit("m@1")), t="abcdef") == "ab/cd/abcdef.m@1.json"
    assert one(spark, text.garbled_ratio(F.col("t")), t="a�b�") == 0.5
    assert one(spark, text.garbled_ratio(F.col("t")), t="") == 0.0
    assert one(spark, text.size_text(F.col("n")), n=1536) == "1.5 KB"
    assert one(spark, text.plain_unicode(F.col("t")), t="Ａ１​　x") == "A1 x"
    assert one(spark, text.known(F.col("x")), x=float("nan")) is None
    assert one(spark, text.data_url(F.encode("t", "utf-8"), F.lit("a/b.JPG")), t="x") == "data:image/jpeg;base64,eA=="


def test_excerpt_json_round_trip(spark):
    from docloom.schema import EXCERPT

    df = spark.sql("SELECT array(named_struct('page_index', 1, 'type', 'text', 'bbox', array(0.0d, 0.1d, 0.2d, 0.3d), 'content', repeat('x', 300))) s")
    back = df.select(text.excerpt_rows(text.excerpt_json(F.col("s")), EXCERPT).alias("e")).first().e
    assert len(back) == 1 and len(back[0].content) == 200 and back[0].bbox == [0.0, 0.1, 0.2, 0.3]
    assert spark.range(1).select(text.excerpt_rows(F.lit("not json"), EXCERPT)).first()[0] is None
    assert df.select(text.excerpt_json(F.slice("s", 1, 0))).first()[0] is None
