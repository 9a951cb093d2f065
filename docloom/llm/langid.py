"""Languages of records and of the passages of mixed records, by prediction by partial matching (problem 1)."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from docloom.llm.batches import map_texts
from docloom.llm.encodings import CHAINS, tokens, undo
from docloom.llm.languages import LANGUAGES, code
from docloom.llm.lookalikes import readable

#: Longest context in bytes.
ORDER = 4
#: The models are fitted on at most so many labelled records a language, of at most so many characters each, in so many rounds of cleaning.
TRAIN_RECORDS, TRAIN_CHARS, ROUNDS = 240, 20_000, 2
#: Bits that a change of language within a record costs, and bits a byte beyond which text is no natural language.
SWITCH, NATURAL = 4.0, 4.2
#: A language counts in a paragraph from so many sentences on; a record needs so many bytes of words to have a language.
SENTENCES, LEAST_BYTES = 2, 8

_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_SENTENCE = re.compile(r"[.!?…][\"”’»)\]]*(?=\s*$|\s+[^\s\da-zà-ÿα-ωά-ώа-яё])|[。？！]")
#: Signs of wrong decoding: the first bytes of UTF-8 read as letters or frames, with what such bytes are followed by.
_GARBLED = re.compile("[ÃÂÅÄÐÑÎÏâ├┬╨╤√‚ΓВГРСв][\x80-¿Œ-ſƒˆ˜†-™€─-◿Ђ-Џђ-џ¬∞≥-≫ÇáéíóúñÑªº]")
_LISTED = re.compile(r"\s*(?:#|\*{2,}|\||<t|[-*+•–—·o]\s|\d{1,3}[.)]\s|[a-zA-Z][.)]\s)")

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
for _c in range(97, 123):
    _FOLD[_c] = _c


def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the models see, of all pieces, and the size of each: lower case, runs of other ASCII than letters as one space."""
    raw = np.frombuffer("\x01".join([*pieces, ""]).lower().encode("utf-8", "replace"), np.uint8)
    raw = np.where(raw == 1, raw, _FOLD[raw])
    space = raw == 32
    raw = raw[~(space & np.concatenate([[False], (space | (raw == 1))[:-1]]))]
    ends = np.flatnonzero(raw == 1)
    sizes = np.diff(np.concatenate([[-1], ends])) - 1
    return raw, sizes


def _grams(raw: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """n bytes ending at each byte of the pieces, as one number; before a piece stand spaces."""
    own = raw != 1
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    offset = np.arange(len(raw)) - np.repeat(starts, sizes + 1)
    out = np.zeros(len(raw), np.uint64)
    for j in range(n - 1, -1, -1):
        byte = np.full(len(raw), 32, np.uint8)
        byte[j:] = raw[: len(raw) - j] if j else raw
        byte[offset < j] = 32
        out = out << np.uint64(8) | byte
    return out[own]


class Table:
    """Open-addressed hash table from numbers to rows, looked up by arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(8, int(np.ceil(np.log2(max(2, len(keys)) * 2.5))))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, at, self.probes = np.arange(len(keys), dtype=np.int32), self._hash(keys), 0
        while len(left):
            self.probes += 1
            free = self.slots[at] < 0
            take, first = np.unique(at[free], return_index=True)
            self.slots[take] = left[free][first]
            placed = self.slots[at] == left
            left, at = left[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it isn't there."""
        at = self._hash(keys)
        row = self.slots[at]
        hit = self.keys[row] == keys if len(self.keys) else np.zeros(len(keys), bool)
        open_ = np.flatnonzero((row >= 0) & ~hit)
        out = np.where((row >= 0) & hit, row, -1)
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            row = self.slots[at[open_]]
            hit = (row >= 0) & (self.keys[row] == keys[open_])
            out[open_[hit]] = row[hit]
            open_ = open_[(row >= 0) & ~hit]
        return out


class Models:
    """Context trees of all languages over the union of their contexts, frozen.

    ``cost[k]`` has, for each k + 1 bytes that some language has seen, the exact code length in bits of the last byte
    after the k before it in every language: method C, from the longest seen context down, an escape for each context
    that has seen other bytes only, none for contexts never seen. ``escape[k]`` has the escapes of contexts of k bytes.
    """

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        m = len(self.languages)
        raws = [encode(texts[lang]) for lang in self.languages]
        self.tables: list[Table] = []
        self.contexts: list[Table] = []
        self.costs: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for k in range(ORDER + 1 if m else 0):
            seen = []
            for own in raws:
                seen.append(np.unique(_grams(*own, k + 1), return_counts=True))
            keys = np.unique(np.concatenate([g for g, _ in seen]))
            contexts = np.unique(keys >> np.uint64(8))
            escape = np.zeros((len(contexts), m), np.float32)
            cost = self._below(keys, k)
            own_context = np.searchsorted(contexts, keys >> np.uint64(8))
            for j, (grams, counts) in enumerate(seen):
                at = np.searchsorted(contexts, grams >> np.uint64(8))
                total, kinds = np.bincount(at, counts, len(contexts)), np.bincount(at, minlength=len(contexts))
                known = total > 0
                bits = np.zeros(len(contexts))
                bits[known] = -np.log2(kinds[known] / (total[known] + kinds[known]))
                cost[:, j] += bits[own_context]
                cost[np.searchsorted(keys, grams), j] = -np.log2(counts / (total[at] + kinds[at]))
                escape[:, j] = bits
            self.contexts.append(Table(contexts))
            self.tables.append(Table(keys))
            self.costs.append(cost)
            self.escapes.append(escape)

    def _below(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Code lengths at order k - 1 of the keys' last bytes."""
        if k == 0:
            return np.full((len(keys), len(self.languages)), 8.0, np.float32)
        return self._cost(keys & np.uint64((1 << 8 * k) - 1), k - 1)

    def _cost(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of the last bytes of keys of k + 1 bytes, whether or not any language has seen them."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        at = np.arange(len(keys))
        while len(at):
            row = self.tables[k].find(keys)
            hit = row >= 0
            out[at[hit]] += self.costs[k][row[hit]]
            at, keys = at[~hit], keys[~hit]
            if not len(at):
                break
            context = self.contexts[k].find(keys >> np.uint64(8))
            there = context >= 0
            out[at[there]] += self.escapes[k][context[there]]
            if k == 0:
                out[at] += 8.0
                break
            keys = keys & np.uint64((1 << 8 * k) - 1)
            k -= 1
        return out

    def bits(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact code lengths of pieces of text (pieces x languages), each after a space, and their bytes."""
        raw, sizes = encode(pieces)
        total = np.zeros((len(pieces), len(self.languages)))
        if sizes.sum():
            filled = np.flatnonzero(sizes)
            starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
            total[filled] = np.add.reduceat(self._cost(_grams(raw, sizes, ORDER + 1), ORDER), starts, axis=0)
        return total, sizes


def sentences(block: str) -> list[tuple[str, bool]]:
    """Pieces of a block with whether each is a sentence; list items, table rows and headings are none."""
    out, at = [], 0
    for m in _SENTENCE.finditer(block):
        out.append((block[at : m.end()], True))
        at = m.end()
    if block[at:].strip():
        out.append((block[at:], False))
    if _LISTED.match(block):
        return [(p, False) for p, _ in out]
    return out


def _blocks(texts: list[str]) -> list[str]:
    return [b for t in texts for b in _BLANK.split(readable(t)) if b.strip()]


def _cleaned(models: Models, lang: str, blocks: list[str]) -> list[str]:
    """The blocks that are in a language as far as models fitted on other records can tell."""
    if not blocks:
        return []
    bits, sizes = models.bits(blocks)
    own = bits[:, models.languages.index(lang)]
    keep = (own <= bits.min(1)) & (own <= NATURAL * np.maximum(1, sizes)) & (sizes >= 20)
    return [b for b, k in zip(blocks, keep.tolist(), strict=True) if k]


def train(sample: dict[str, list[str]]) -> Models:
    """Models from labelled texts some of which have a wrong label or are mixed.

    Each half of the sample is cleaned by models of the other half, so that no text speaks for its own label, and the
    models of the next round are fitted on what is left.
    """
    whole = {lang: (_blocks(t[::2]), _blocks(t[1::2])) for lang, t in sample.items()}
    halves = whole
    for _ in range(ROUNDS):
        models = [Models({lang: h[i] for lang, h in halves.items()}) for i in (0, 1)]
        halves = {lang: tuple(_cleaned(models[1 - i], lang, h[i]) or h[i] for i in (0, 1)) for lang, h in whole.items()}
    return Models({lang: [*a, *b] for lang, (a, b) in halves.items()})


def fit(docs: DataFrame, key: str = "ext_id", text: str = "markdown", lang: str = "lang") -> Models:
    """Models of the languages that labels name, from a bounded sample of labelled records.

    Takes the records with the least hashes of their keys, ``TRAIN_RECORDS`` a language. ``train`` deals with the wrong labels.
    """
    meant = F.create_map(*(F.lit(x) for name, c in sorted({n: c for c, names in LANGUAGES.items() for n in (c, *names)}.items()) for x in (name, c)))
    label = F.try_element_at(meant, F.split(F.lower(F.trim(F.col(lang))), "[-_]")[0])
    rows = docs.select(label.alias("label"), F.xxhash64(key).alias("h"), F.col(text).alias("text")).where(F.col("label").isNotNull() & F.col("h").isNotNull() & (F.length(text) <= TRAIN_CHARS))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h"))).where(F.col("r") <= TRAIN_RECORDS)
    sample: dict[str, list[str]] = defaultdict(list)
    for r in first.select("label", "text").collect():
        sample[r.label].append(r.text)
    return train(sample)


class Reader:
    """Judges whole records by the models."""

    def __init__(self, models: Models):
        self.models = models

    def read(self, texts: list[str]) -> list[tuple[str | None, float, list[tuple[int, str, int, float]]]]:
        """Per text: its main language or None, the confidence, and (paragraph, language, sentences, confidence) of its passages."""
        pieces, owner = [], []
        for i, text in enumerate(texts):
            plain = readable(text).replace("�", " ")
            n = 0
            for block in _BLANK.split(plain):
                if block.strip():
                    n += 1
                    for piece, whole in sentences(block):
                        pieces.append(piece)
                        owner.append((i, n, whole))
        out: list = [(None, 0.0, [])] * len(texts)
        if not pieces or not self.models.languages:
            return out
        bits, sizes = self.models.bits(pieces)
        self._mend(pieces, bits, sizes)
        at = 0
        while at < len(owner):
            i, end = owner[at][0], at
            while end < len(owner) and owner[end][0] == i:
                end += 1
            out[i] = self._record(bits[at:end], sizes[at:end], owner[at:end])
            at = end
        return out

    def _mend(self, pieces: list[str], bits: np.ndarray, sizes: np.ndarray) -> None:
        """Wrongly decoded pieces take the code lengths of the best reading of any encoding chain."""
        rate = bits.min(1) / np.maximum(1, sizes)
        doubtful = [k for k in np.flatnonzero(rate > 1.5).tolist() if _GARBLED.search(pieces[k]) or rate[k] > 2.2 and sum(not c.isascii() for c in pieces[k]) * 20 > len(pieces[k])]
        tries, owner = [], []
        for k in doubtful:
            text = pieces[k]
            found = [(a, b, text[a:b]) for a, b, *_ in tokens(text)]
            for chain in CHAINS:
                made, lacking = [], 0
                for a, b, token in found:
                    before = undo(token, chain)
                    lacking += before is None
                    if lacking * 2 > len(found):  # more than half of all tokens: the chain is out, whatever the others are
                        break
                    made.append((a, b, before))
                if not found or lacking * 2 > len(found):
                    continue
                parts, at = [], 0
                for a, b, x in made:
                    parts += [text[at:a], x if x is not None else " "]
                    at = b
                tries.append("".join([*parts, text[at:]]))
                owner.append(k)
        if tries:
            other, size = self.models.bits(tries)
            better = other.min(1) / np.maximum(1, size)  # by bits a byte: a garbled character is several bytes of its own
            for j in np.argsort(-better, kind="stable").tolist():
                if better[j] < rate[owner[j]]:
                    bits[owner[j]], sizes[owner[j]] = other[j], size[j]

    def _record(self, bits: np.ndarray, sizes: np.ndarray, owner: list) -> tuple:
        rate = bits.min(1) / np.maximum(1, sizes)
        natural = (rate <= NATURAL) & (sizes >= 3)
        if sizes[natural].sum() < LEAST_BYTES or sizes[natural].sum() * 3 < sizes.sum():
            return None, 0.0, []
        cost = np.where(natural[:, None], bits, 0.0)
        names = self.models.languages
        firsts = cost.argmin(1)
        own = set(firsts[natural].tolist())
        path = [own.pop()] * len(cost) if len(own) == 1 else _viterbi(cost)
        amount, count, lead = defaultdict(int), defaultdict(int), defaultdict(float)
        low = np.partition(cost, 1, axis=1) if len(names) > 1 else np.pad(cost, ((0, 0), (0, 1)), constant_values=1e9)
        leads = np.where(firsts == path, low[:, 1] - low[:, 0], low[:, 0] - cost[np.arange(len(cost)), path])
        for (_, n, whole), j, size, gain, ok in zip(owner, path, sizes.tolist(), leads.tolist(), natural.tolist(), strict=True):
            if ok:
                amount[j] += size
                count[n, j] += whole
                lead[n, j] += gain
        passages = [(n, names[j], c, _confidence(lead[n, j])) for (n, j), c in sorted(count.items()) if c >= SENTENCES]
        main = max(amount, key=lambda j: (amount[j], -j))
        whole = cost.sum(0)
        others = np.delete(whole, main)
        return names[main], _confidence(others.min() - whole[main] if len(others) else 20.0), passages


def _confidence(bits: float) -> float:
    """Posterior of a language that leads the next one by so many bits."""
    return float(1 / (1 + 2.0 ** -max(-50.0, min(50.0, bits))))


def _viterbi(cost: np.ndarray) -> list[int]:
    """Cheapest languages of a record's pieces, if a change costs ``SWITCH`` bits."""
    best, back = cost[0].copy(), []
    for row in cost[1:]:
        low = int(best.argmin())
        move = best[low] + SWITCH < best
        back.append(np.where(move, low, np.arange(len(best))))
        best = np.where(move, best[low] + SWITCH, best) + row
    j = int(best.argmin())
    path = [j]
    for step in reversed(back):
        j = int(step[j])
        path.append(j)
    return path[::-1]


def languages(docs: DataFrame, key: str = "ext_id", text: str = "markdown", lang: str = "lang") -> DataFrame:
    """Per distinct record: rows ``key``, para_no, lang, confidence, label.

    Row 0 has the record's main language. If the record is mixed, that is at least two languages have two or more
    sentences of some paragraph each, a row follows for each paragraph and language with two or more sentences. Records
    without natural language, also NULL, empty and blank ones, have row 0 with a NULL language and confidence 0. ``label``
    is the language that the record's label means, or NULL.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, key, text, lang))

    def make():
        reader = Reader(shared.value)

        def f(keys, texts):
            out = {"k": [], "para_no": [], "lang": [], "confidence": [], "label": []}
            for k, label, (main, sure, passages) in zip(*keys, reader.read(texts), strict=True):
                if k is None:
                    continue
                mixed = len({x[1] for x in passages}) > 1
                for row in [(0, main, sure), *((n, lang, c) for n, lang, _, c in passages if mixed)]:
                    for column, value in zip(out, (k, *row, code(label)), strict=True):
                        out[column].append(value)
            return out

        return f

    return map_texts(docs, [key, lang], text, "k bigint, para_no int, lang string, confidence double, label string", make).withColumnRenamed("k", key).distinct()


def wrong_labels(docs: DataFrame) -> DataFrame:
    """(ext_id, para_no, lang): mixed records by paragraph; of the others row 0 if the label doesn't mean the language."""
    rows = languages(docs)
    mixed = F.max(F.col("para_no")).over(Window.partitionBy("ext_id"))
    found = rows.withColumn("most", mixed).where("lang IS NOT NULL AND (para_no > 0 OR most = 0 AND (label IS NULL OR label != lang))")
    return found.select("ext_id", "para_no", "lang").distinct()
