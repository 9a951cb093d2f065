"""Repetition inside a record by suffix arrays over its words (problem 5)."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.batches import map_texts

#: A repeated run counts from so many words on; a record is repetitive from such a share on.
MIN_RUN, MIN_SHARE = 5, 0.3
#: Limit on a record's longest repeat, in words, where that is limited as well.
MOST_REPEATED = 100

_SIGNS = re.compile(r"[^\w\s]+")
_MARKUP = re.compile(r"<[^<>\n]{1,40}>")
#: Han text has no word spaces: each character is half a word.
_WORD = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+")


class SuffixArray:
    """The suffixes of a block of documents that share their first 2**START words with another one of their document, in order.

    ``order`` has their positions, documents apart; ``common`` the longest common prefix, in words, of each with the one
    before it. Ranks come from prefix doubling, of which a step looks at tied suffixes only; ``ranks[k]`` tells by equal
    numbers which suffixes of a document share 2**k words.
    """

    #: Suffixes that share fewer than 2**START words need no order: no run that counts is so short.
    START = 2

    def __init__(self, docs: np.ndarray, words: np.ndarray):
        n = len(words)
        self.size = n
        rank = np.unique(docs.astype(np.int64) << 32 | words, return_inverse=True)[1].astype(np.int64)
        self.ranks, length = [rank], 1
        for _ in range(self.START):
            rank = np.unique(rank << 32 | _later(rank, length), return_inverse=True)[1].astype(np.int64)
            self.ranks.append(rank)
            length *= 2
        sizes = np.bincount(rank)
        tied = np.flatnonzero(sizes[rank] > 1)
        rank = self.ranks[-1] = (np.cumsum(sizes) - sizes)[rank]  # a group's rank is the number of suffixes before it: it keeps its place as it splits
        own, rank = tied, rank.copy()
        while len(own):
            key = np.stack([rank[own], _later(rank, length)[own]])
            order = np.lexsort(key[::-1])
            own, key = own[order], key[:, order]
            group = np.concatenate([[True], (np.diff(key, axis=1) != 0).any(0)])
            outer = np.concatenate([[True], np.diff(key[0]) != 0])
            at = np.arange(len(own))
            new = key[0] + np.maximum.accumulate(np.where(group, at, 0)) - np.maximum.accumulate(np.where(outer, at, 0))
            rank = rank.copy()
            rank[own] = new
            self.ranks.append(rank)
            length *= 2
            again = np.bincount(np.cumsum(group) - 1)[np.cumsum(group) - 1] > 1
            own = own[again]
        self.order = tied[np.argsort(rank[tied], kind="stable")]
        self.common = np.concatenate([[0], self.prefix(self.order[:-1], self.order[1:])]) if len(tied) else np.zeros(0, np.int64)

    def prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of the suffixes at a and at b of the same documents."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = np.minimum(a + total, self.size - 1), np.minimum(b + total, self.size - 1)
            total += (self.ranks[k][x] == self.ranks[k][y]) << k
        return total

    def shared(self, k: int, docs: np.ndarray) -> np.ndarray:
        """Documents in which two suffixes share 2**k words, k up to START."""
        _, inverse, sizes = np.unique(self.ranks[k], return_inverse=True, return_counts=True)
        return np.unique(docs[sizes[inverse] > 1])


def _later(rank: np.ndarray, shift: int) -> np.ndarray:
    return np.concatenate([rank[shift:], np.zeros(min(shift, len(rank)), np.int64)])


def earlier(order: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    """By position, the length of the longest run from there that also began before it, from the suffix array's intervals.

    Suffixes with a longest common prefix of some length are an interval; intervals are nested. From the deepest one out,
    all of an interval's suffixes but the leftmost in the text repeat a maximal run of that length, and that one goes on
    into the interval around it.
    """
    longest = np.zeros(size, np.int64)
    if not len(order):
        return longest
    at, depth = order.tolist(), [*common[1:].tolist(), 0]
    open_: list[tuple[int, int]] = []  # (common prefix, leftmost position) of the intervals around the place
    for node, d in zip(at, depth, strict=True):
        while open_ and open_[-1][0] > d:
            length, left = open_.pop()
            longest[max(left, node)] = length
            node = min(left, node)
        if open_ and open_[-1][0] == d and d:
            left = open_[-1][1]
            longest[max(left, node)] = d
            open_[-1] = (d, min(left, node))
        elif d:
            open_.append((d, node))
    return longest


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """Words, words inside repeated runs, and the longest repeat in word tokens, of each text."""
    ids: dict[str, int] = {}
    docs, words = [], []
    for i, text in enumerate(texts):
        if "<" in text:
            text = _MARKUP.sub(" ", text)
        # signs go without a gap: they don't divide a word, also not the signs of wrongly decoded words
        found = _WORD.findall(_SIGNS.sub("", text).lower())
        # a token of its own ends each document: no repeat crosses a border
        docs.append(np.full(len(found) + 1, i, np.int64))
        words.append(np.fromiter((ids.setdefault(w, len(ids)) for w in [*found, i]), np.int64, len(found) + 1))
    doc, word = np.concatenate(docs), np.concatenate(words)
    n = len(word)
    kind = np.array([0 if isinstance(w, int) else 1 if "㐀" <= w[0] <= "鿿" else 2 for w in ids])
    weight = kind[word]
    suffixes = SuffixArray(doc, word)
    run = earlier(suffixes.order, suffixes.common, n)
    before = np.concatenate([[0], np.cumsum(weight)])
    start = np.flatnonzero(run)
    start = start[before[start + run[start]] - before[start] >= 2 * MIN_RUN]  # long enough to count, Han characters by halves
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + run[start], -1)
    covered = np.cumsum(marks)[:n] > 0
    longest = np.zeros(len(texts), np.int64)
    longest[suffixes.shared(0, doc)] = 1
    longest[suffixes.shared(1, doc)] = 2
    three = np.unique(suffixes.ranks[1] << 32 | _later(suffixes.ranks[1], 1), return_inverse=True, return_counts=True)
    longest[np.unique(doc[three[2][three[1]] > 1])] = 3
    np.maximum.at(longest, doc[suffixes.order], suffixes.common)
    return {"words": np.bincount(doc, weight, len(texts)) / 2, "repeated": np.bincount(doc, weight * covered, len(texts)) / 2, "longest": longest}


def repetition(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per record: ``key``, words, repeated_words, repeated_share, longest_repeat (in words; Han characters count singly).

    A word is repeated if it stands in a run of ``MIN_RUN`` or more words that occurred before in the same record; case,
    punctuation and markup aside. NULL, empty and blank texts have no words and share 0. Rows that are the same record
    twice give one row. Texts are measured whole; the work of a block is that of sorting its words.
    """

    def make():
        def f(keys, texts):
            m = measure(texts)
            return {"k": keys[0], "words": m["words"], "repeated_words": m["repeated"], "repeated_share": m["repeated"] / np.maximum(m["words"], 0.5), "longest_repeat": m["longest"]}

        return f

    return map_texts(docs, [key], text, "k bigint, words double, repeated_words double, repeated_share double, longest_repeat bigint", make).withColumnRenamed("k", key).distinct()


def repetitive(docs: DataFrame, key: str, text: str, longest: int | None = None) -> DataFrame:
    """Keys of the records beyond the limits: at least ``MIN_SHARE`` of the words in repeated runs or, where ``longest`` is given, a repeat longer than that."""
    over = F.col("repeated_share") >= MIN_SHARE
    if longest is not None:
        over |= F.col("longest_repeat") > longest
    return repetition(docs, key, text).where(over).select(key).distinct()
