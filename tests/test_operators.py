import pytest
from pyspark.sql import functions as F

from docloom import config
from docloom.operators import curation, features, layout, neardup, reports, review, routing


def test_stage_closure():
    assert config.stage_closure(["parquet"]) == ["router", "extract", "quality", "parquet"]
    assert config.stage_closure(["layout"]) == ["router", "layout"]
    assert config.stage_closure(["quality", "router"]) == ["router", "extract", "quality"]
    with pytest.raises(ValueError):
        config.stage_closure(["bogus"])


def test_config_precedence():
    c = config.build({"router": {"ocr_threshold": 0.3, "unknown": 1}, "vlm": {"enabled": False}, "other": {}}, ocr_threshold=0.7, vlm=True, no_quality=True)
    assert c.router.ocr_threshold == 0.7 and c.vlm.enabled and "quality" not in c.stages and "parquet" not in c.stages


def test_stage_a_boundary(spark):
    df = spark.createDataFrame([(0.4999,), (0.5,), (0.9,)], "p double")
    assert [r[0] for r in df.select(routing.stage_a(F.col("p"))).collect()] == ["mupdf", "pipeline", "pipeline"]
    assert [r[0] for r in df.select(routing.stage_a(F.col("p"), vlm_enabled=True)).collect()] == ["mupdf", "deferred", "deferred"]


def test_kept_boundary(spark):
    rows = [(None, 2.0), (None, 1.999), (None, None), ("router", 3.0), (None, float("nan"))]
    df = spark.createDataFrame(rows, "e string, s double")
    assert [r[0] for r in df.select(routing.kept(F.col("e"), F.col("s"))).collect()] == [True, False, False, False, False]


def test_known_scanner(spark):
    df = spark.createDataFrame([("Canon iR", None), ("LaTeX", "Scandinavia PDF"), ("LaTeX", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(routing.known_scanner(F.col("a"), F.col("b"))).collect()] == [True, True, False, False]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 8, 9, 3000])
def test_percentiles(spark, n):
    df = spark.createDataFrame([(10 * (i + 1),) for i in range(n)], "v bigint")
    v = [10 * (i + 1) for i in range(n)]
    wanted = (v[0], v[n // 4], v[n // 2], v[3 * n // 4], v[-1]) if n else (0, 0, 0, 0, 0)
    assert tuple(reports.percentiles(df, "v").first()) == wanted


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.3, 0.999, 1.0, -0.2, 1.7, None, float("nan"))], "v double")
    got = {r.bin: r.n for r in reports.histogram(df, "v", 0.0, 1.0).collect()}
    assert len(got) == 20 and {k: v for k, v in got.items() if v} == {0: 2, 1: 1, 6: 1, 19: 3}
    assert reports.histogram(df.where("v IS NULL"), "v", 0.0, 1.0).count() == 0


def test_latest_flags(spark):
    rows = [("a", True, "t1", 1), ("a", False, "t1", 2), ("b", True, "2024", 3), ("b", False, None, 4), (None, True, "x", 5)]
    df = spark.createDataFrame(rows, "sha256 string, is_bad boolean, flagged_at string, line bigint")
    assert sorted((r.sha256, r.line) for r in review.latest_flags(df, "line").collect()) == [("a", 2), ("b", 3)]
    assert [r.sha256 for r in review.active_flags(df, "line").collect()] == ["b"]


def test_latest_flags_by_text_or_time(spark):
    rows = [("a", True, "2026-05-18T10:00:00+08:00", 1), ("a", False, "2026-05-18T03:00:00+00:00", 2)]
    df = spark.createDataFrame(rows, "sha256 string, is_bad boolean, flagged_at string, line bigint")
    assert review.latest_flags(df, "line").first().line == 1
    assert review.latest_flags(df, "line", by_time=True).first().line == 2


def test_log_skips_bad_lines(spark):
    from docloom.schema import BAD_CASES

    lines = spark.createDataFrame([("",), ("{bad",), ('{"is_bad":true}',), ('{"sha256":"x","is_bad":true,"later":1}',)], "value string")
    assert [r.sha256 for r in review.parsed_log(lines, BAD_CASES).collect()] == ["x"]


def test_merged_labels(spark):
    base = spark.createDataFrame([("1", "a", "u", None), ("2", None, None, None)], "id string, label string, annotator string, annotated_at string")
    updates = spark.createDataFrame(
        [("1", {"label": None}, 1), ("1", {"label": "b"}, 2), ("9", {"label": "z"}, 3), ("2", {"label": "c", "annotator": None}, 4), (None, {"label": "q"}, 5)], "id string, set map<string,string>, pos bigint"
    )
    got = {r.id: (r.label, r.annotator, r.annotated_at) for r in review.merged_labels(base, updates, "id", ["label", "annotator"], "pos", F.lit("now")).collect()}
    assert got == {"1": ("b", "u", "now"), "2": ("c", None, "now")}
    assert review.exported_labels(base).first().total == 1


def test_reading_order(spark):
    rows = [("s", 3, "text", 0.9, (0.6, 0.1, 0.7, 0.2), 0), ("s", 3, "figure", 0.9, (0.2, 0.1, 0.3, 0.2), 1), ("s", 3, "Table", 0.9, (0.1, 0.5, 0.3, 0.6), 2), ("s", 3, "abandon", 0.9, (0.0, 0.0, 1.0, 1.0), 3), ("s", 3, "text", 0.1, (0.0, 0.0, 1.0, 1.0), 4)]
    df = spark.createDataFrame(rows, "sha256 string, page_index int, label string, confidence double, bbox struct<x0:double,y0:double,x1:double,y1:double>, det_index int")
    got = [(r.region_id, r.type) for r in layout.detected(df).orderBy("reading_order").collect()]
    assert got == [("p3_r0", "image"), ("p3_r1", "text"), ("p3_r2", "table")]


def test_feature_vector_and_samples(spark):
    assert len(features.vector_columns()) == 124
    assert features.padding(1) == [0] * 7 and features.padding(3) == [2, 0, 2, 2, 0] and features.padding(7) == [6]
    assert features.page_choice(20) == [0, 1, 2, 3, 7, 8, 11, 16]
    assert features.sample_table(spark, 3).where("num_pages = 3").count() == 8


def test_documents_of_any_length_have_page_samples(spark):
    docs = spark.createDataFrame([("a", 65), ("b", 3000), ("c", 3), ("c", 3), ("d", 0), ("e", None), ("f", 20), ("g", 65)], "pdf_path string, num_pages int")
    got = {}
    for r in features.page_samples(docs).orderBy("pdf_path", "slot").collect():
        got.setdefault(r.pdf_path, []).append(r.page_index)
    assert sorted(got) == ["a", "b", "c", "f", "g"] and all(len(x) == 8 for x in got.values())
    assert got["a"] == got["g"] == features.page_choice(65) and got["b"] == features.page_choice(3000) and got["f"] == features.page_choice(20)


def test_long_documents_keep_their_rows_in_the_query(spark, tmp_path):
    from docloom import catalogue

    spark.createDataFrame([("a", 65), ("c", 3)], "pdf_path string, num_pages int").write.parquet(f"{tmp_path}/router_decisions.parquet")
    assert sorted(r.pdf_path for r in catalogue.features_page_sample(spark, str(tmp_path)).select("pdf_path").distinct().collect()) == ["a", "c"]


def test_junk_images(spark):
    rows = [("a", p, 7, 3) for p in range(3)] + [("b", p, 7, 3) for p in range(2)] + [("c", p, 7, 2) for p in range(2)]
    df = spark.createDataFrame(rows, "doc string, page int, xref bigint, n_pages int")
    assert [r.doc for r in features.junk_images(df).collect()] == ["a"]


def test_page_features(spark):
    spans = spark.createDataFrame([("d", 0, "F", "abcd", 0, 1.0, 10.0, 2.0, 100.0, 100.0), ("d", 0, "", "xy", 3, 1.0, 5.0, 2.0, 100.0, 100.0), ("d", 1, "F", "z", 0, 0.0, 1.0, 1.0, 0.0, 0.0)], "doc string, page int, font string, text string, type int, opacity double, width double, height double, page_width double, page_height double")
    rows = {r.page: r for r in features.text_features(spans).collect()}
    assert (rows[0].unique_font_counts, rows[0].char_counts, rows[0].hidden_char_counts, rows[0].text_area_ratios) == (1, 4, 2, 0.002)
    assert rows[1].text_area_ratios == 1.0 and rows[1].hidden_text_box_counts == 1
    draw = spark.createDataFrame([("d", 0, 1, "l", True), ("d", 0, 1, "re", True), ("d", 0, 2, "re", False), ("d", 0, 2, "c", None)], "doc string, page int, path int, item string, stroked boolean")
    r = features.drawing_features(draw).first()
    assert (r.drawing_strokes_count, r.vector_graphics_obj_count) == (3, 2)
    images = spark.createDataFrame([("d", 0, 1, 1, 0.0, 0.0, 100.0, 50.0, 100.0, 200.0), ("d", 0, 2, 1, 0.0, 51.0, 100.0, 100.0, 100.0, 200.0)], "doc string, page int, xref bigint, n_pages int, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double")
    r = features.image_features(images).first()
    assert (r.image_counts, r.max_merged_strip_areas) == (2, 0.5)


def test_luhn_and_pii(spark):
    df = spark.createDataFrame([("4539578763621486",), ("4539578763621487",)], "n string")
    assert [r[0] for r in df.select(curation.luhn(F.col("n"))).collect()] == [True, False]
    text = spark.createDataFrame([("mail a.b@c.org or 10.0.0.1, 13812345678 end",)], "t string")
    assert text.select(curation.redacted(F.col("t"))).first()[0] == "mail ⟨PII:email⟩ or ⟨PII:ipv4⟩, ⟨PII:phone⟩ end"


def test_repeated_ngrams(spark):
    df = spark.createDataFrame([("a b c d e a b c d e",), ("a b",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(curation.repeated_ngrams(F.col("t"))).collect()]
    assert got[0] == pytest.approx(1 / 6) and got[1:] == [0.0, 0.0, 0.0]


def test_empty_tables(spark, tiny_dir):
    results = spark.read.parquet(f"{tiny_dir}/doc_results.parquet").limit(0)
    assert reports.run_summary(results).first().num_pdfs == 0
    assert reports.distributions(results).count() == 0
    assert reports.dashboard(results, kept_only=True).count() == 0
    segments = spark.read.parquet(f"{tiny_dir}/segments.parquet").limit(0)
    assert layout.merged(segments).count() == 0 and routing.stage_b_rows(segments).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    import random

    r = random.Random(4)
    rows = []
    for base in range(12):
        words = [f"w{r.randint(0, 400)}" for _ in range(120)]
        for v in range(4):
            changed = list(words)
            for _ in range(v):
                changed[r.randrange(120)] = f"x{r.randint(0, 9999)}"
            rows.append((base * 10 + v, " ".join(changed)))
    rows += [(500 + i, "one  text\tthat is copied") for i in range(30)] + [(900, None), (901, " "), (902, "short"), (902, "short"), (None, "x")]
    got = {x.doc_id: (x.class_id, x.links) for x in neardup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {k: set(neardup.shingles(t).tolist()) for k, t in rows if k is not None and t and t.strip() and k < 500}
    near = {k: {j for j in sets if j != k and len(sets[k] & sets[j]) >= 0.85 * len(sets[k] | sets[j])} for k in sets}
    label = dict.fromkeys(sets)
    for k in sorted(sets):
        todo = [k] if label[k] is None else []
        while todo:
            x = todo.pop()
            if label[x] is None:
                label[x] = k
                todo += near[x]
    assert {k: v for k, v in got.items() if k < 500} == {k: (label[k], len(near[k])) for k in sets}
    assert {got[500 + i] for i in range(30)} == {(500, 0)} and got[902] == (902, 0) and 900 not in got and 901 not in got


def test_zipped_goes_as_far_as_both(spark):
    df = spark.createDataFrame([([1, 2, 3], ["a", "b"]), ([], ["a"])], "r array<int>, s array<string>")
    got = [[(x.region, x.result) for x in row[0]] for row in df.select(layout.zipped(F.col("r"), F.col("s"))).collect()]
    assert got == [[(1, "a"), (2, "b")], []]


def test_personal_data_of_all_kinds(spark):
    kinds = {
        "card": "4111111111111111", "ipv6": "2001:0db8:0000:0000:0000:ff00:0042:8329", "plate": "京A12345", "email": "a.b@c.org",
        "ipv4": "10.1.2.3", "phone": "13812345678", "passport": "E12345678",
    }
    rows = [*kinds.items(), ("none", "4111111111111112"), ("plain", "nothing here"), ("empty", ""), ("null", None)]
    df = spark.createDataFrame(rows, "kind string, text string")
    got = {r.kind: r.out for r in df.select("kind", curation.redacted(F.col("text")).alias("out")).collect()}
    assert {k: v for k, v in got.items() if k in kinds} == {k: f"⟨PII:{k}⟩" for k in kinds}
    assert got["none"] == "4111111111111112" and got["plain"] == "nothing here" and got["empty"] == "" and got["null"] is None
    audit = curation.pii_audit(spark.createDataFrame([(1, "a@b.org c@d.org a@b.org"), (2, None)], "id int, text string"), "id", "text").collect()
    assert sorted((r.kind, r.n) for r in audit) == [("email", 1), ("email", 2)]


def test_labels_of_each_detector(spark):
    df = spark.createDataFrame([("Figure",), ("FIGURE",), ("abandon",), ("Seal",), ("Isolate formula",), (None,)], "label string")
    got = [(r.pp, r.yolo) for r in df.select(layout.region_type(F.col("label"), "pp").alias("pp"), layout.region_type(F.col("label"), "yolo").alias("yolo")).collect()]
    assert got == [("image", "image"), ("image", "text"), ("text", None), ("image", "text"), ("text", "formula"), ("text", "text")]


def test_counts_go_up(spark):
    from docloom.functions import text

    df = spark.createDataFrame([({"a": 1}, "a"), ({"a": 1}, "b"), ({}, "c")], "m map<string,int>, k string")
    assert [r.n for r in df.select(text.incremented(F.col("m"), F.col("k")).alias("n")).collect()] == [{"a": 2}, {"a": 1, "b": 1}, {"c": 1}]


def test_flags_that_the_log_refuses():
    from docloom.operators import review

    for bad in ({"sha256": ""}, {"sha256": "x", "stage": "other"}, {"sha256": "x", "tags": [1]}):
        with pytest.raises(ValueError):
            review.flag(**bad, at="2024")


def test_commands(spark, tiny_dir, tmp_path):
    from docloom.__main__ import main

    assert main(["run", tiny_dir, f"{tmp_path}/out", "--vlm"], spark) == 0
    published = spark.read.parquet(f"{tmp_path}/out/dataset.parquet")
    assert published.count() == spark.read.parquet(f"{tiny_dir}/router_decisions.parquet").select("pdf_path").distinct().count()
    summary = spark.read.json(f"{tmp_path}/out/summary").first()
    assert summary.num_pdfs == published.count() and summary.by_backend
    main(["review", f"{tmp_path}/log", "a" * 64, "--stage", "layout"], spark)
    main(["review", f"{tmp_path}/log", "a" * 64, "--withdraw"], spark)
    from docloom.operators import review
    from docloom.sources import readers

    assert review.active_flags(readers.bad_case_log(spark, f"{tmp_path}/log")).count() == 0


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from docloom import session

    lone = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_folder(lone, "x")
