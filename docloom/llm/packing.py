"""Items of varying length in containers of fixed capacity: batches inside optimal length buckets (problem 8)."""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from docloom.llm.batches import map_texts
from docloom.session import cut_lineage

#: Default vocabulary of token sizes, by name in the installed package of public tokenizers.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Items of one length are ranked in windows of about so many, so that a frequent length is no single task.
RANKED = 1_000_000


def tokenizer(path: str | None = None):
    """A tiktoken encoding of a rank file; None is ``VOCABULARY``."""

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(``key``, tokens) of each distinct document, whole texts; NULL texts have 0 tokens."""

    def make():
        encoding = tokenizer(path)

        def f(keys, texts):
            return {"k": keys[0], "tokens": [len(encoding.encode_ordinary(t)) for t in texts]}

        return f

    return map_texts(docs.where(F.col(key).isNotNull()), [key], text, "k bigint, tokens bigint", make).groupBy("k").agg(F.max("tokens").alias("tokens")).withColumnRenamed("k", key)


def buckets(counts: np.ndarray, capacity: int) -> tuple[list[int], int]:
    """Upper ends of the length buckets with least padding, and that padding in tokens.

    ``counts[s]`` items have length s. A container of the bucket that ends at length b holds capacity // b items, whatever
    their lengths; dynamic programming over the lengths that occur weighs all divisions into buckets.
    """
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths > 0]
    n = np.concatenate([[0], np.cumsum(counts[lengths])])
    total = np.concatenate([[0], np.cumsum(counts[lengths] * lengths)])
    best, back = np.zeros(len(lengths) + 1, np.int64), np.zeros(len(lengths) + 1, np.int64)
    for i, b in enumerate(lengths, 1):
        held = capacity // int(b)
        cost = best[:i] + -(-(n[i] - n[:i]) // held) * capacity - (total[i] - total[:i])
        back[i] = int(cost.argmin())
        best[i] = cost[back[i]]
    ends, i = [], len(lengths)
    while i:
        ends.append(int(lengths[i - 1]))
        i = int(back[i])
    return ends[::-1], int(best[-1])


@dataclass
class Plan:
    """Where the items of each length go: rank r in [low, next low) of length ``size`` to container first + (skip + r - low) // each."""

    size: np.ndarray
    low: np.ndarray
    first: np.ndarray
    each: np.ndarray
    skip: np.ndarray
    containers: int
    bucket_ends: list[int]
    padding: int

    def place(self, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Container numbers of items by their length and rank among the items of that length."""
        at = np.searchsorted(self.size, size, side="right") - 1
        if len(self.size) > len(np.unique(self.size)):  # several rows a length: ranks beyond 2**40 don't fit beside a length in one number
            first = np.searchsorted(self.size, size, side="left")
            for _ in range(int((at - first).max(initial=0)).bit_length()):
                middle = (first + at + 1) // 2
                right = self.low[middle] <= rank
                first, at = np.where(right, middle, first), np.where(right, at, np.maximum(first, middle - 1))
            at = first
        return self.first[at] + (self.skip[at] + rank - self.low[at]) // self.each[at]


class _Open:
    """Containers with room, those of equal room as intervals of numbers."""

    def __init__(self, capacity: int):
        self.free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.rooms: list[int] = []

    def add(self, room: int, first: int, many: int) -> None:
        if room > 0 and many > 0:
            if not self.free[room]:
                insort(self.rooms, room)
            self.free[room].append((first, many))

    def take(self, size: int, most: int) -> tuple[int, int] | None:
        """Up to ``most`` containers in a row with the least room that an item of this size fits, the item put into each."""
        i = bisect_left(self.rooms, size)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        first, many = self.free[room].pop()
        if not self.free[room]:
            del self.rooms[i]
        taken = min(many, most)
        self.add(room, first + taken, many - taken)
        self.add(room - size, first, taken)
        return first, taken


def plan(counts: np.ndarray, capacity: int, top_up: bool = True, ends: list[int] | None = None) -> Plan:
    """Token-budget batches inside the optimal buckets; what longer buckets' batches leave free takes items of shorter buckets first.

    Works on the histogram alone, from the longest bucket down. A bucket that ends at length b puts capacity // b items
    into a batch, its own items only, in order of length. With ``top_up`` each of its items first goes to the batch of a
    longer bucket with the least room that it fits, if there is one, so that only what finds no room there forms batches.
    """
    best, padding = buckets(counts, capacity)
    ends = best if ends is None else ends
    room, rows, fresh = _Open(capacity), [], 0
    lows = [0, *ends[:-1]]
    for below, end in zip(reversed(lows), reversed(ends), strict=True):
        held, rest, position, made = capacity // end, [], 0, []
        for s in (np.flatnonzero(counts[below + 1 : end + 1])[::-1] + below + 1).tolist():
            n, rank = int(counts[s]), 0
            while top_up and rank < n and (got := room.take(s, n - rank)):
                rows.append((s, rank, got[0], 1, 0))
                rank += got[1]
            if rank < n:
                rows.append((s, rank, fresh + position // held, held, position % held))
                rest.append((s, n - rank))
                position += n - rank
        part, used = 0, 0  # items and tokens in the batch at hand
        for s, n in rest:
            while n:
                if part == 0 and n >= held:
                    made.append((capacity - held * s, n // held))
                    n %= held
                else:
                    k = min(held - part, n)
                    part, used, n = part + k, used + k * s, n - k
                    if part == held:
                        made.append((capacity - used, 1))
                        part, used = 0, 0
        if part:
            made.append((capacity - used, 1))
        for space, many in made:
            room.add(space, fresh, many)
            fresh += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*(table[:, j] for j in range(5)), fresh, ends, padding)


def _items(tokens: DataFrame, key: str, capacity: int) -> DataFrame:
    """(``key``, part, size): documents as items; beyond the capacity, full pieces and what remains."""
    c = F.lit(capacity).cast("bigint")
    last = F.ceil(F.col("tokens") / c).cast("bigint") - 1
    parts = tokens.where("tokens > 0").select(key, "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part"))
    return parts.select(key, "part", F.least(c, F.col("tokens") - F.col("part") * c).alias("size"))


def _ranked(items: DataFrame, key: str, counts: np.ndarray, window: int) -> DataFrame:
    """Items with their dense rank among those of one size; a size of more than ``window`` items is counted in parts of about so many."""
    salts = [(int(s), int(-(-counts[s] // window))) for s in np.flatnonzero(counts > window)]
    salt = F.lit(0).cast("bigint")
    if salts:  # at most one row a size, so at most capacity rows
        hot = items.sparkSession.createDataFrame(salts, "size bigint, salts bigint")
        items = items.join(F.broadcast(hot), "size", "left")
        salt = F.coalesce(F.pmod(F.xxhash64(key, "part"), F.col("salts")), salt)
    own = F.row_number().over(Window.partitionBy("size", "salt").orderBy(key, "part")) - 1
    salted = items.select(key, "part", "size", salt.alias("salt"))
    if not salts:
        return salted.select(key, "part", "size", own.cast("bigint").alias("rank"))
    sums = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return salted.withColumn("own", own).join(sums.select("size", "salt", before.alias("before")), ["size", "salt"]).select(key, "part", "size", (F.col("own") + F.col("before")).alias("rank"))


def _bins(bins: DataFrame) -> list[tuple[str, int]]:
    return [(r.bin_name, r.capacity_tokens) for r in bins.where("capacity_tokens > 0").select("bin_name", "capacity_tokens").distinct().orderBy("capacity_tokens", "bin_name").collect()]


def _histogram(items: DataFrame, capacity: int) -> np.ndarray:
    counts = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("size").agg(F.count("*").alias("n")).collect():
        counts[r["size"]] = r.n
    return counts


def packed(docs: DataFrame, bins: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = RANKED) -> DataFrame:
    """One row per item: bin_name, ``key``, part, size, container.

    Containers are numbered per bin from 0. A text is one item (part 0) unless it exceeds the capacity; then its parts but
    the last are full. Texts without tokens (NULL, empty) need no space and give no row, repeated rows count once, bins
    without a positive capacity are left out. The driver sees per bin the histogram of sizes, so at most capacity rows,
    and sends the plan, a few rows a size; items are ranked and placed where they are.
    """
    tokens = cut_lineage(sizes(docs, key, text, path))
    spark = docs.sparkSession
    schema = f"bin_name string, {key} bigint, part bigint, size bigint, container bigint"
    out = None
    for name, capacity in _bins(bins):
        items = _items(tokens, key, capacity)
        counts = _histogram(items, capacity)
        shared = spark.sparkContext.broadcast((name, plan(counts, capacity)))

        def place(batches, shared=shared):
            name, p = shared.value
            for batch in batches:
                size, rank = (batch.column(j).to_numpy(zero_copy_only=False) for j in (2, 3))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(size)), batch.column(0), batch.column(1), batch.column(2), pa.array(p.place(size, rank))], names=["bin_name", key, "part", "size", "container"])

        part = _ranked(items, key, counts, window).mapInArrow(place, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def report(docs: DataFrame, bins: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per bin: items, tokens, containers, unused_share; n_buckets, and the unused share of the buckets' batches without top-up."""
    tokens = cut_lineage(sizes(docs, key, text, path))
    rows = []
    for name, capacity in _bins(bins):
        counts = _histogram(_items(tokens, key, capacity), capacity)
        total = int((counts * np.arange(capacity + 1)).sum())
        p, plain = plan(counts, capacity), plan(counts, capacity, top_up=False)
        unused = lambda x, total=total, capacity=capacity: 1 - total / max(1, x.containers * capacity)
        rows.append((name, capacity, int(counts.sum()), total, p.containers, unused(p), len(p.bucket_ends), plain.containers, unused(plain)))
    schema = "bin_name string, capacity_tokens int, n_items bigint, n_tokens bigint, n_containers bigint, unused_share double, n_buckets int, bucket_containers bigint, bucket_unused_share double"
    return docs.sparkSession.createDataFrame(rows, schema)
