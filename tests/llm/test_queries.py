import pytest
from oracle import compare, connect

from docloom.llm import entry

COLUMNS = {
    "p1_found": {"ext_id": "bigint", "para_no": "int", "lang": "string"},
    "p2_found": {"rec_table": "string", "rec_id": "bigint"},
    "p3_found": {"rec_table": "string", "id_a": "bigint", "id_b": "bigint"},
    "p4_found": {"ext_id": "bigint"},
    "p5_found": {"ext_id": "bigint"},
    "p6_found": {"ext_id": "bigint", "kind": "string"},
    "p7_found": {"result_id": "bigint"},
    "p9_found": {"doc_id": "bigint", "item_id": "bigint"},
    "p10_found": {"doc_id": "bigint", "reading_level": "int"},
}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_runs_with_its_columns_and_distinct_rows(spark, tiny_dir, name):
    df = entry.queries()[name](spark, tiny_dir)
    if name in COLUMNS:
        assert dict(df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert len(rows) == len(set(rows))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, tiny_dir, name):
    mine, other, kinds = compare(entry.queries()[name](spark, tiny_dir), connect(tiny_dir), entry.oracle_sql()[name])
    assert mine == other and not kinds


TABLES = {
    "extracted_docs": "ext_id bigint, sha256 string, backend string, markdown string, stats map<string,string>, lang string, source string, extracted_at timestamp_ntz, k bigint, text string",
    "segments": "seg_id bigint, sha256 string, seg_index int, backend string, page_index int, seg_type string, content string, bbox struct<x0:double,y0:double,x1:double,y1:double>, source_region_id string, source string, raw bigint",
    "doc_results": "result_id bigint, source string, extract_backend string, quality_score double, sha256 string, markdown_chars bigint, n bigint, cutoff double",
    "keep_targets": "source string, extract_backend string, keep_percent int",
    "documents": "doc_id bigint, text string, lang string, source string, item_id bigint, tokens bigint",
    "eval_items": "item_id bigint, text string, doc_id bigint",
    "level_samples": "sample_id bigint, lang string, reading_level int, text string",
    "pack_bins": "bin_name string, capacity_tokens int",
}


def write(spark, folder, rows):
    for name, ddl in TABLES.items():
        spark.createDataFrame(rows.get(name, []), ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_empty_tables(spark, tmp_path, name):
    assert entry.queries()[name](spark, write(spark, tmp_path, {})).count() == 0


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """NULLs in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    none = lambda ddl: (None,) * (ddl.count(" ") - ddl.count(", ") + 0)
    del none
    long = "The cat sees every dog because our house needs a tree. " * 4000
    doc = lambda i, t: (i, f"s{i}", "mupdf", t, None, "en", "a", None, 1, "x")
    seg = lambda i, t: (i, "s", i, "mupdf", 0, "text", t, None, None, None, 5)
    res = lambda i, q, s="a": (i, s, "mupdf", q, "s1", 3, 1, 2.0)
    texts = ["", "   ", "\n", None, long, "x" * 100_000, "same", "same", "the cat sees", "12 34", "。" * 50, "😀 ok".encode("utf-16", "surrogatepass").decode("utf-16")]
    rows = {
        "extracted_docs": [(None,) * 10, *(doc(i, t) for i, t in enumerate(texts, 1)), doc(5, long), (99, None, None, "The cat.", None, None, None, None, None, None)],
        "segments": [(None,) * 11, *(seg(i, t) for i, t in enumerate(texts, 1)), seg(5, long)],
        "doc_results": [(None,) * 8, *(res(i, 1.0) for i in range(5)), res(2, 1.0), res(7, None), res(8, float("nan")), res(9, float("inf")), res(10, float("-inf")), res(11, 2.0, None), res(12, 0.5)],
        "keep_targets": [(None, None, None), ("a", "mupdf", 50), ("a", "mupdf", 40), ("b", "mupdf", 10), ("a", None, 5)],
        "documents": [(None,) * 6, *((i, t, "en", "a", 1, 2) for i, t in enumerate(texts, 1)), (5, long, "en", "a", 1, 2)],
        "eval_items": [(None, None, None), (1, None, 1), (2, "", 1), (3, "too short", 1), (4, "the cat sees every dog because our house needs a tree", 1), (5, "The cat sees every dog, because our house needs a tree", 1)],
        "level_samples": [(None, None, None, None), (1, "en", 1, "the cat sees the dog " * 5), (2, "en", 4, "heterogeneous covariance stipulates taxonomy " * 5), (3, "en", 9, "out of range"), (4, "en", 2, None)],
        "pack_bins": [(None, None), ("none", 0), ("small", 8), ("small", 8), ("large", 1000)],
    }
    return write(spark, tmp_path_factory.mktemp("odd"), rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_odd_rows(spark, odd_dir, name):
    rows = entry.queries()[name](spark, odd_dir).collect()
    assert len(rows) == len(set(rows))
    if name == "p9_found":
        assert sorted(map(tuple, rows)) == [(5, 4), (5, 5)]
    if name == "p7_found":
        assert sorted(r[0] for r in rows) == [0, 1, 2, 3, 4, 9]
    if name == "p5_found":
        assert {r[0] for r in rows} >= {5}
    if name == "p3_found":
        assert rows == []
    if name == "p10_found":
        assert [tuple(r) for r in rows] == [(5, 1)]
    if name == "p8_packed":
        used = {}
        for r in rows:
            used[r.bin_name, r.container] = used.get((r.bin_name, r.container), 0) + r["size"]
        assert all(n <= {"small": 8, "large": 1000}[b] for (b, _), n in used.items())
