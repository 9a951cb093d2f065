import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docloom.config import build
from docloom.plans import pipeline, providers
from docloom.sources import readers, writers
from docloom.streaming import streams

ROOT = Path(__file__).resolve().parents[1] / "docloom"


def test_only_the_subpackage_imports_itself():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("docloom.llm") for n in names), path


def test_pipeline(spark, tiny_dir):
    decisions, segments = (spark.read.parquet(f"{tiny_dir}/{n}.parquet") for n in ("router_decisions", "segments"))
    rows = pipeline.run(decisions, segments).cache()
    assert rows.count() == decisions.select("pdf_path").distinct().count()
    assert rows.where("error_class IS NOT NULL AND kept").count() == 0
    assert rows.where("kept AND quality_score < 2.0").count() == 0
    assert pipeline.run(decisions, segments, build({}, no_quality=True)).where("kept").count() == 0


def test_sinks_and_sources(spark, tiny_dir, tmp_path):
    table = pipeline.run(*(spark.read.parquet(f"{tiny_dir}/{n}.parquet") for n in ("router_decisions", "segments")))
    writers.publish(table, f"{tmp_path}/t")
    assert readers.result_table(spark, f"{tmp_path}/t").count() == table.count()
    writers.json_lines(table.limit(3), f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 3
    log = spark.read.parquet(f"{tiny_dir}/badcases.parquet")
    writers.append_log(log, f"{tmp_path}/log")
    writers.append_log(log, f"{tmp_path}/log")
    assert readers.bad_case_log(spark, f"{tmp_path}/log").count() == 2 * log.where("sha256 <> ''").count()
    assert readers.bad_case_log(spark, f"{tmp_path}/absent").count() == 0
    packed = table.select(F.col("pdf_path").alias("id"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit("high").alias("quality_bucket"))
    writers.package(packed, f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p/parquet").count() == spark.read.json(f"{tmp_path}/p/jsonl").count() == table.count()


def test_pdf_scan_and_ingest(spark, tmp_path):
    docs = tmp_path / "docs"
    for name in ("b/two.pdf", "a/one.pdf", "c/no.PDF", "three.pdf"):
        path = docs / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    files = readers.pdf_files(spark, str(docs), limit=2)
    assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == ["one.pdf", "two.pdf"]
    assert readers.bucket_listing(spark, str(docs)).count() == 3
    out, mark = f"{tmp_path}/out", f"{tmp_path}/mark"
    work = lambda df: df.select(F.sha2("content", 256).alias("sha256"), "length")
    streams.ingest(spark, str(docs), out, mark, work)
    assert spark.read.parquet(out).count() == 3
    (docs / "four.pdf").write_bytes(b"4")
    streams.ingest(spark, str(docs), out, mark, work)
    assert spark.read.parquet(out).count() == 4


def test_layout_cache(spark, tmp_path):
    from docloom import schema
    from docloom.operators import layout, routing

    rows = [("abcdef", "m@1", [(0, 100.0, 200.0, [("p0_r0", "table", (0.0, 0.0, 1.0, 1.0), 0.9, 0)])]), ("abcdef", "m@2", [(0, 100.0, 200.0, [("p0_r0", "text", (0.0, 0.0, 1.0, 1.0), 0.9, 0)])])]
    writers.save_layouts(spark.createDataFrame(rows, schema.LAYOUT), f"{tmp_path}/cache")
    cached = readers.cached_layouts(spark, f"{tmp_path}/cache")
    docs = spark.createDataFrame([("abcdef",), ("zz",), (None,)], "sha256 string")
    got = {r.sha256: r.stage_b for r in routing.stage_b_cached(docs, cached).collect()}
    assert got == {"abcdef": "pipeline", "zz": None, None: None}
    assert layout.flattened(cached).count() == 2


def test_providers(spark):
    @providers.register("length@test")
    def length():
        return lambda texts: [float(len(t)) for t in texts]

    with pytest.raises(ValueError):
        providers.factory("absent")
    score = providers.scorer(providers.factory("length@test"))
    df = spark.createDataFrame([("ab",), ("abcdef",), ("  ",), (None,)], "t string")
    assert [r[0] for r in df.select(score(F.col("t"))).collect()] == [2.0, 3.0, 0.0, 0.0]
    parse = providers.parser(spark.createDataFrame([("k", bytearray(b"x")), ("l", None)], "sha256 string, content binary"), lambda: lambda b: [{"content": b.decode()}], "sha256 string, content string, error string")
    got = {r.sha256: (r.content, r.error is None) for r in parse.collect()}
    assert got == {"k": ("x", True), "l": (None, False)}
