import pytest
from pyspark.sql import functions as F

from docloom.functions import geometry


def box(spark, *v):
    return spark.createDataFrame([(v,)], "b struct<x0:double,y0:double,x1:double,y1:double>")


@pytest.mark.parametrize(("v", "ok"), [((-0.1, 0.0, 0.5, 0.5), False), ((0.0, 0.0, 1.1, 0.5), False), ((0.5, 0.0, 0.3, 0.5), False), ((0.0, 0.0, 0.0, 0.0), True)])
def test_valid(spark, v, ok):
    assert box(spark, *v).select(geometry.valid(F.col("b"))).first()[0] is ok


def test_null_box_is_not_valid(spark):
    assert spark.createDataFrame([(None,)], "b struct<x0:double,y0:double,x1:double,y1:double>").select(geometry.valid(F.col("b"))).first()[0] is False


def test_pixels_and_crop(spark):
    df = box(spark, 0.1, 0.2, 0.9, 0.8)
    assert df.select(geometry.to_pixels(F.col("b"), F.lit(1000), F.lit(500))).first()[0] == [100, 100, 900, 400]
    half = box(spark, 0.25, 0.35, 0.25, 0.35)
    assert half.select(geometry.to_pixels(F.col("b"), F.lit(10), F.lit(10))).first()[0][:1] == [2]
    assert half.select(geometry.crop(F.col("b"), F.lit(10), F.lit(10))).first()[0] == [2, 3, 2, 3]


def test_clamped(spark):
    assert tuple(box(spark, -0.5, 0.2, 1.5, 0.4).select(geometry.clamped(F.col("b"))).first()[0]) == (0.0, 0.2, 1.0, 0.4)
    assert box(spark, 1.2, 0.2, 1.5, 0.4).select(geometry.clamped(F.col("b"))).first()[0] is None


def brute(images, w, h):
    seen, kept = set(), []
    for i in images:
        if i[:4] not in seen:
            seen.add(i[:4])
            kept.append(i)
    kept.sort(key=lambda i: (i[1], i[0]))
    out = kept[:1]
    for x0, y0, x1, y1, n in kept[1:]:
        a, b, c, d, _ = out[-1]
        across = w > 0 and abs(x1 - x0) >= 0.9 * w and abs(a - x0) <= 5 and abs(c - x1) <= 5 and abs(y0 - d) <= 2
        down = h > 0 and abs(y1 - y0) >= 0.9 * h and abs(b - y0) <= 5 and abs(d - y1) <= 5 and abs(x0 - c) <= 2
        if across or down:
            out[-1] = (min(x0, a), min(y0, b), max(x1, c), max(y1, d), n)
        else:
            out.append((x0, y0, x1, y1, n))
    return out


def test_merged_strips(spark):
    images = [(0, 0, 100, 50, 1), (0, 51, 100, 100, 2), (0, 51, 100, 100, 9), (3, 101, 98, 150, 3), (0, 160, 40, 190, 4)]
    images = [tuple(map(float, i[:4])) + (i[4],) for i in images]
    df = spark.createDataFrame([(images, 100.0, 200.0), ([], 100.0, 200.0)], "i array<struct<x0:double,y0:double,x1:double,y1:double,id:bigint>>, w double, h double")
    first, empty = df.select(geometry.merged_strips(F.col("i"), F.col("w"), F.col("h"))).collect()
    assert [tuple(b) for b in first[0]] == brute(images, 100, 200) == [(0, 0, 100, 150, 3), (0, 160, 40, 190, 4)]
    assert empty[0] == []
