"""Evaluation passages inside a corpus: size-partitioned MinHash containment search, verified by exact shingle containment (problem 9)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.batches import blocks, map_texts
from docloom.llm.lookalikes import one_form
from docloom.session import cut_lineage

#: A leaked passage has so many words of the item in a row; an item leaks from such a share of its words on.
RUN, SHARE = 6, 0.4
#: Probability, at most, that the sketch of an item has no shingle of a document that it leaks into.
MISS = 1e-4
#: A paragraph that opens or closes so many items of different text is an instruction, not part of their passages.
STOCK = 3
#: A filter over shingles or keys has 32 bits for each, and at most 2 to this power bits (32 MB): beyond that it lets more through, which the join drops.
FILTER_BITS = 28
#: Rows of sketches or passages' shingles that are sent to all tasks at most; more meet the documents' shingles in a shuffle.
SENT = 1_000_000
#: Words whose hashes a task keeps.
KNOWN = 500_000

_BROKEN = re.compile(r"(?<=\w)[-­‐¬]\s*\n\s*(?=\w)")
_MARKUP = re.compile(r"<[^<>\n]{1,40}>")
_WORD = re.compile(r"[^\W_]+")
_PARAGRAPH = re.compile(r"\n\s*\n")
_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    """Words of a text; case, punctuation, spacing, line division and markup aside."""
    text = _BROKEN.sub("", text)
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    return _WORD.findall(one_form(text).lower())


class Shingler:
    """Shingles of texts, with the hashes of words that it has met."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, found: list[str]) -> list[int]:
        known, out = self.known, []
        if len(known) > KNOWN:
            known.clear()
        for w in found:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) | 1
            out.append(h)
        return out

    def shingles(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the runs of RUN words, and the number of the text that each stands in; none crosses a border."""
        ids: list[int] = []
        sizes = []
        for found in texts:
            ids += self.hashes(found)
            ids.append(0)
            sizes.append(len(found) + 1)
        ids = np.array(ids, np.uint64)
        n = len(ids) - RUN + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(RUN):
                h = (h ^ ids[j : j + n]) * _MULT
                h ^= h >> np.uint64(29)
        borders = np.concatenate([[0], np.cumsum(ids == 0)])
        at = np.flatnonzero(borders[RUN:] == borders[:n])
        return h[at], borders[at]


def least_shared(multiplicity: list[int], size: int) -> int:
    """Least number of different shingles that a document holds if an item of ``size`` words leaks into it.

    SHARE of the words stand in runs of RUN or more; each run has a shingle for every RUN words or part of them. A shingle
    that the item repeats may stand for as many of these as the item has of it.
    """
    wanted, have, n = -(-int(np.ceil(SHARE * size - 1e-9)) // RUN), 0, 0
    for m in sorted(multiplicity, reverse=True):
        if have >= wanted:
            break
        have, n = have + m, n + 1
    return max(1, n)


def size_class(shared: int) -> int:
    """Number of the partition of items that share at least so many shingles with a document that they leak into."""
    return shared.bit_length() - 1


def rate(size_class: int) -> float:
    """Share of all shingle values, those with the least hashes, that the sketches of a size class are made of.

    An item of the class shares at least 2**size_class shingles with a document that it leaks into. That none of them is
    among the least has a probability of at most MISS.
    """
    return 1.0 if size_class == 0 else 1 - MISS ** (1 / 2**size_class)


def sketched(h: np.ndarray, share: float) -> np.ndarray:
    """Which shingles are among the share of all values with the least hashes."""
    if share >= 1:
        return np.ones(len(h), bool)
    with np.errstate(over="ignore"):
        u = h * _MIX
        return u ^ u >> np.uint64(32) < np.uint64(share * 2**64)


class Filter:
    """A Bloom filter of three slices of well mixed 64-bit numbers; it may let others through, but stops none of its own."""

    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(max(1, (1 << bits) // 64), np.uint64) if table is None else table

    def _slots(self, h: np.ndarray):
        mask = np.uint64((1 << self.bits) - 1)
        for shift in (0, 18, 36):
            yield (h >> np.uint64(shift)) & mask

    def add(self, h: np.ndarray) -> None:
        for s in self._slots(h):
            np.bitwise_or.at(self.table, s >> np.uint64(6), np.uint64(1) << (s & np.uint64(63)))

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for s in self._slots(h):
            out &= (self.table[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) != 0
        return out


def _mixed(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.astype(np.int64).view(np.uint64) * _MULT
        h = (h ^ h >> np.uint64(31)) * _MIX
        return h ^ h >> np.uint64(29)


def built(values: DataFrame, count: int, mix: bool = False) -> Filter:
    """A ``Filter`` of a column of ``count`` bigints: tasks fill tables, whose words meet by bitwise or; the driver gets the at most 2**FILTER_BITS bits."""
    bits = max(10, min(FILTER_BITS, int(np.ceil(np.log2(32 * max(1, count))))))

    def fill(batches):
        own = Filter(bits)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            own.add(_mixed(h) if mix else h.astype(np.int64).view(np.uint64))
        at = np.flatnonzero(own.table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own.table[at].view(np.int64))], names=["at", "word"])

    rows = values.mapInArrow(fill, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    table = Filter(bits).table
    table[rows["at"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return Filter(bits, table)


def bodies(items: DataFrame) -> DataFrame:
    """(item_id, passage, body): the words of each item's text without stock paragraphs; items with the same passage share its number.

    Paragraphs are counted where they are: the items may be many more than a driver holds.
    """

    def make():
        def f(keys, texts):
            out = {"item_id": [], "text_key": [], "no": [], "of": [], "body": []}
            for i, t in zip(keys[0], texts, strict=True):
                parts = [p for p in _PARAGRAPH.split(t) if p.strip()]
                key = xxhash.xxh3_128_hexdigest("\0".join(parts).encode("utf-8", "surrogatepass"))
                for no, p in enumerate(parts):
                    for n, v in zip(out, (i, key, no, len(parts), " ".join(words(p))), strict=True):
                        out[n].append(v)
            return out

        return f

    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    parts = map_texts(rows, ["item_id"], "text", "item_id bigint, text_key string, no int, of int, body string", make)
    ends = parts.where("of > 1 AND (no = 0 OR no = of - 1)").select("text_key", "body").distinct()
    stock = ends.groupBy("body").agg(F.count("*").alias("n")).where(F.col("n") >= STOCK).select("body", F.lit(True).alias("stock"))
    kept = parts.join(stock, "body", "left").where("body != '' AND (of = 1 OR stock IS NULL)")
    inner = F.sort_array(F.collect_list(F.struct("no", "body")))
    whole = kept.groupBy("item_id", "text_key").agg(F.array_join(F.transform(inner, lambda x: x["body"]), " ").alias("body"))
    return whole.select("item_id", F.xxhash64("body").alias("passage"), "body")


def grams(passages: DataFrame) -> DataFrame:
    """(passage, pos, h, size, class): the shingles of each passage; class is the size class whose sketch holds the shingle, else NULL."""

    def make():
        shingler = Shingler()

        def f(keys, texts):
            split = [t.split(" ") for t in texts]
            h, owner = shingler.shingles(split)
            out = {"passage": [], "pos": [], "h": h.view(np.int64), "size": [], "class": []}
            for k, found in enumerate(split):
                own = h[owner == k] if len(split) > 1 else h
                if not len(own):
                    continue
                c = size_class(least_shared(np.unique(own, return_counts=True)[1].tolist(), len(found)))
                out["passage"] += [keys[0][k]] * len(own)
                out["pos"] += range(len(own))
                out["size"] += [len(found)] * len(own)
                out["class"] += np.where(sketched(own, rate(c)), c, -1).tolist()
            out["class"] = [c if c >= 0 else None for c in out["class"]]
            return out

        return f

    return map_texts(passages, ["passage"], "body", "passage bigint, pos int, h bigint, size int, class int", make)


def _met(docs: DataFrame, key: str, text: str, share: float, known, keys=None) -> DataFrame:
    """(k, h): the shingles of each document, of this share of the values, that a broadcast filter lets through; with a filter of keys, only of documents that it lets through."""

    def run(batches):
        shingler, own = Shingler(), known.value
        wanted = keys.value if keys else None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            if wanted:
                mask = wanted.has(_mixed(k))
                batch, k = batch.filter(pa.array(mask)), k[mask]
            at = 0
            for _, texts in blocks(batch, 1):
                h, owner = shingler.shingles([words(t) for t in texts])
                mask = sketched(h, share)
                h, owner = h[mask], owner[mask]
                mask = own.has(h)
                found = np.unique(np.stack([owner[mask].astype(np.uint64), h[mask]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(k[at + found[0].astype(np.int64)], pa.int64()), pa.array(found[1].view(np.int64))], names=["k", "h"])
                at += len(texts)

    return docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("k"), text).mapInArrow(run, "k bigint, h bigint")


def candidates(docs: DataFrame, shingles: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, passage): documents that hold a shingle of a passage's sketch.

    Items are partitioned by size class; the sketches of a class are its items' shingles among the share ``rate`` of the
    values, the least hashes. One scan of the corpus meets the sketches of all classes, whatever the number of items.
    """
    spark = docs.sparkSession
    sketches = shingles.where("class IS NOT NULL").select("passage", "h").distinct()
    counts = {r[0]: r.n for r in shingles.where("class IS NOT NULL").groupBy("class").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    known = spark.sparkContext.broadcast(built(shingles.where("class IS NOT NULL").select("h"), total))
    hits = _met(docs, key, text, max(map(rate, counts), default=0.0), known)
    return hits.join(F.broadcast(sketches) if total <= SENT else sketches, "h").select("k", "passage").distinct()


def contained(docs: DataFrame, shingles: DataFrame, pairs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, passage, contained): the exact share of the passage's words that the document of a pair holds in runs of RUN or more.

    Only documents that some pair has are read for their shingles; a filter of their keys, bounded in size, spares the rest.
    """
    spark = docs.sparkSession
    keys, wanted = pairs.select("k").distinct(), shingles.join(pairs.select("passage").distinct(), "passage", "left_semi")
    n = pairs.count()
    known = wanted.count()
    shared = spark.sparkContext.broadcast(built(wanted.select("h"), known))
    hits = _met(docs, key, text, 1.0, shared, spark.sparkContext.broadcast(built(keys, n, mix=True))).distinct()
    wanted = wanted.select("passage", "pos", "h", "size")
    rows = hits.join(F.broadcast(wanted) if known <= SENT else wanted, "h").join(F.broadcast(pairs) if n <= SENT else pairs, ["k", "passage"])
    at = rows.groupBy("k", "passage", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    start = F.struct(F.lit(0).alias("n"), F.lit(-RUN).alias("last"))
    held = F.aggregate("at", start, lambda a, x: F.struct((a["n"] + F.least(F.lit(RUN), x - a["last"])).alias("n"), x.alias("last")))["n"]
    return at.select("k", "passage", (held / F.col("size")).alias("contained"))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (``key``, item_id, contained): documents that hold at least ``SHARE`` of an item's words in passages of ``RUN`` or more.

    Items are the stated query set; they may be many, and none reach the driver. Size-partitioned MinHash containment
    gives the candidates (see ``candidates``), exact shingle containment decides. Documents are read twice, their texts are
    never shuffled and never paired with each other. Items without ``RUN`` words, NULL texts and keys and empty tables give
    no rows; items with the same passage leak together; repeated rows count once. Stock instructions are no part of a passage.
    """
    known = cut_lineage(bodies(items))
    shingles = cut_lineage(grams(known.groupBy("passage").agg(F.first("body").alias("body"))))
    pairs = cut_lineage(candidates(docs, shingles, key, text))
    found = contained(docs, shingles, pairs, key, text).where(F.col("contained") >= SHARE)
    return found.join(known.select("passage", "item_id"), "passage").select(F.col("k").alias(key), "item_id", "contained").distinct()


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs, items).select("doc_id", "item_id").distinct()


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per leaked item: item_id, n_docs and the greatest contained share."""
    return leaks(docs, items).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("contained").alias("most_contained"))
