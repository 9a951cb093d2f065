"""Near-duplicate classes of texts: MinHash bands give the candidates, exact similarity decides, links connect classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as texts
from docloom.session import cut_lineage

#: Words of a shingle, least similarity of shingle sets, hash functions and rows of a band.
WORDS, SIMILARITY, HASHES, ROWS = 5, 0.85, 126, 6
_PRIME = np.uint64((1 << 61) - 1)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of ``WORDS`` words in lower case; a shorter text is one shingle."""
    words = text.lower().split()
    runs = {" ".join(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))} if words else set()
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(r) >> 3 for r in runs), np.uint64, len(runs)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    draw = np.random.RandomState(1)
    mult = draw.randint(1, 1 << 31, HASHES).astype(np.uint64) << np.uint64(30) | draw.randint(0, 1 << 30, HASHES).astype(np.uint64) | np.uint64(1)
    for batch in batches:
        ids, bands, sets = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = shingles(text)
            if not len(s):
                continue
            low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
            for part in np.array_split(s, max(1, len(s) // 4096)):  # bounded memory for long texts
                with np.errstate(over="ignore"):
                    mixed = part[:, None] * mult[None]
                    mixed ^= mixed >> np.uint64(32)
                low = np.minimum(low, mixed.min(0))
            ids.append(key)
            bands.append([xxhash.xxh3_64_intdigest(low[i : i + ROWS].tobytes(), seed=i) >> 1 for i in range(0, HASHES, ROWS)])
            sets.append(s.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))], names=["t", "bands", "shingles"])


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(t, class_id) with the least node that links (a, b) reach: labels spread and take short cuts until none changes.

    Each round is one shuffle of links and is cut off by a reliable checkpoint; rounds grow with the logarithm of the
    longest path. Links and labels never leave the executors, only the number of changes does.
    """
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.select("t", F.col("t").alias("class_id")))
    while True:
        near = both.join(labels, both.b == labels.t).groupBy("a").agg(F.min("class_id").alias("low"))
        spread = labels.join(near, labels.t == near.a, "left").select("t", F.least("class_id", F.coalesce("low", "class_id")).alias("class_id"))
        jump = spread.select(F.col("t").alias("j"), F.col("class_id").alias("further"))
        after = cut_lineage(spread.join(jump, spread.class_id == jump.j).select("t", "further").withColumnRenamed("further", "class_id"))
        changed = after.join(labels.withColumnRenamed("class_id", "old"), "t").where("class_id != old").limit(1).count()
        labels = after
        if not changed:
            return labels


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document with words: ``key``, class_id (the least ``key`` of its class), links, copies.

    Equal normalized texts are one text (``copies`` documents hold it); only different texts are paired. ``links`` is the
    number of other texts at least ``similarity`` alike by the Jaccard index of their shingles. 21 bands of 6 hashes
    miss a pair at 0.85 with probability below 1e-4. NULL, empty and blank texts give no row; repeated rows count once.
    """
    told = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), texts.normalize_text(F.col(text)).alias("x")).where("x <> ''")
    digest = F.xxhash64("x").alias("h1"), F.xxhash64(F.reverse("x")).alias("h2")
    members = cut_lineage(told.select("k", *digest).distinct())
    reps = members.groupBy("h1", "h2").agg(F.min("k").alias("t"), F.count("*").alias("copies"))
    first = told.join(reps.select(F.col("t").alias("k")), "k").dropDuplicates(["k"])
    signed = cut_lineage(first.select("k", "x").mapInArrow(_signatures, "t bigint, bands array<bigint>, shingles array<bigint>"))
    band = signed.select("t", F.posexplode("bands").alias("n", "h"))
    shared = band.groupBy("n", "h").agg(F.count("*").alias("c")).where("c > 1").select("n", "h")
    few = band.join(shared, ["n", "h"])
    a, b = few.withColumnRenamed("t", "a"), few.withColumnRenamed("t", "b")
    pairs = a.join(b, ["n", "h"]).where("a < b").select("a", "b").distinct()
    sets = signed.select("t", "shingles")
    both = pairs.join(sets.select(F.col("t").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("t").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    links = cut_lineage(both.where(common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b"))
    label = connected(signed.select("t"), links)
    degree = links.select(F.explode(F.array("a", "b")).alias("t")).groupBy("t").agg(F.count("*").alias("links"))
    found = reps.join(label, "t").join(degree, "t", "left").select("h1", "h2", "class_id", F.coalesce("links", F.lit(0).cast("bigint")).alias("links"), "copies")
    return members.join(found, ["h1", "h2"]).select(F.col("k").alias(key), "class_id", "links", "copies")
