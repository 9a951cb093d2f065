"""Reading level of documents by a latent difficulty model of words (problem 10)."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.batches import map_texts
from docloom.session import cut_lineage

LEVELS = 4
#: Documents of fewer words (between white space of any kind) get no level.
MIN_WORDS = 40
#: Slope of the response curve; words below this count or share of a language's words carry no difficulty of their own.
SLOPE, MIN_COUNT, MIN_WORD_SHARE = 2.0, 5, 1e-6
#: Alternations over the whole corpus after the fit to the graded samples: until the log likelihood per word gains less than TOLERANCE, at most so many.
ROUNDS, TOLERANCE = 8, 1e-4
#: The fit reads at most so many graded samples (they are a fixed, small table; beyond it, the least ids).
MAX_SAMPLES = 20_000

_WORD = re.compile(r"[^\W\d_]+")
#: Lines that are no running text: headings, table rows, list items, formulas, tags.
_APART = re.compile(r"^[^\S\n]*(?:#|\||[-*+•–—·▪◦‣][^\S\n]|\*{2,}|\(?(?:\d{1,3}|[a-zA-Z])[.)][^\S\n]|\$\$|\\[a-zA-Z]|<t[adrh])[^\n]*$", re.MULTILINE)
_GRID = np.linspace(-3, 6, 91)
_THETA = np.arange(1, LEVELS + 1, dtype=float)
_CURVE = 1 / (1 + np.exp(-SLOPE * (_THETA[None] - _GRID[:, None])))


def fit_language(counts: np.ndarray, rounds: int = 30) -> np.ndarray:
    """P(word | level) of one language from word counts by level (words x LEVELS).

    A token of a document of level t is word w with probability r_w s(SLOPE (t - b_w)) / Z(t): the word with difficulty
    b_w is at the writer's command as in Rasch's model, r_w is its rate where it is. Alternates between difficulties with
    rates, each word on its own, and the norm Z of each level.
    """
    total, exposure, norm = counts.sum(1), counts.sum(0) + 1e-9, np.ones(LEVELS)
    gain = counts @ np.log(_CURVE).T - 0.02 * _GRID**2
    for _ in range(rounds):
        shares = (exposure * _CURVE / norm).sum(1)
        best = (gain - total[:, None] * np.log(shares)[None]).argmax(1)
        p = (total / shares[best])[:, None] * _CURVE[best]
        norm = p.sum(0)
    return p / norm


def running(text: str) -> list[str]:
    """The words of a document's running text, or all its words if it has none to speak of: samples are running text."""
    words = _WORD.findall(_APART.sub("\n", text).lower())
    return words if len(words) >= MIN_WORDS // 2 else _WORD.findall(text.lower())


class Model:
    """Log probabilities of words at each language and level."""

    def __init__(self, counts: dict[str, dict[str, np.ndarray]], names: list | None = None):
        """From counts by language, word and level; ``names`` are the words by row where that is given."""
        self.languages = sorted(counts)
        words = sorted({w for by in counts.values() for w in by}) if names is None else names[1:]
        self.ids = {w: k for k, w in enumerate(words, 1)}
        floor = np.log(1e-6)
        self.table = np.full((len(words) + 1, max(1, len(self.languages)) * LEVELS), floor, np.float32)
        for j, lang in enumerate(self.languages):
            by = counts[lang]
            if by:
                p = fit_language(np.array(list(by.values()), float))
                self.table[[self.ids[w] for w in by], j * LEVELS : (j + 1) * LEVELS] = np.maximum(floor, np.log(p + 1e-12))
        self.table -= floor  # against a word that says nothing, so that unknown words add nothing

    def score(self, ids: np.ndarray, sizes: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
        """Log likelihoods (texts x languages * LEVELS) of texts of so many rows of the table each, which may stand for several words."""
        out = np.zeros((len(sizes), self.table.shape[1]))
        filled = np.flatnonzero(sizes)
        if len(filled):
            own = self.table[ids] if times is None else self.table[ids] * times[:, None].astype(np.float32)
            out[filled] = np.add.reduceat(own, np.concatenate([[0], np.cumsum(sizes[filled])[:-1]]), axis=0, dtype=np.float64)
        return out


class Words:
    """The words of a block of texts: the different ones, the place of each word among them, and how many words each text has."""

    def __init__(self, texts: list[str]):
        own: dict[str, int] = {}
        found = [running(t) for t in texts]
        self.at = np.array([own.setdefault(w, len(own)) for ws in found for w in ws], np.int64)
        self.words, self.sizes = list(own), np.array([len(ws) for ws in found], np.int64)

    def rows(self, model: Model) -> np.ndarray:
        """The words' rows in a model's table, 0 for unknown ones."""
        get = model.ids.get
        return np.array([get(w, 0) for w in self.words], np.int64)[self.at] if len(self.at) else self.at


def _weights(ll: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts' log likelihoods: the language that explains each best, the posterior of its levels there, and the log of the mean likelihood over these."""
    ll = ll.reshape(len(ll), -1, LEVELS)
    lang = ll.max(2).argmax(1)
    own = ll[np.arange(len(ll)), lang]
    top = own.max(1, keepdims=True)
    p = np.exp(own - top)
    total = p.sum(1, keepdims=True)
    return lang, p / total, (top + np.log(total / LEVELS))[:, 0]


def _by_level(at: np.ndarray, owner: np.ndarray, p: np.ndarray, size: int, times: np.ndarray | None = None) -> np.ndarray:
    """(size x LEVELS) sums over words of the posteriors of their texts."""
    return np.stack([np.bincount(at, p[owner, k] if times is None else p[owner, k] * times, size) for k in range(LEVELS)], axis=1)


def _sample_counts(rows: list) -> dict[str, dict[str, np.ndarray]]:
    counts: dict = defaultdict(lambda: defaultdict(lambda: np.zeros(LEVELS)))
    for r in rows:
        for w in _WORD.findall(r.text.lower()):
            counts[r.lang][w][r.reading_level - 1] += 1
    return {lang: {w: c for w, c in by.items() if c.sum() >= 2} for lang, by in counts.items()}


def fit(docs: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame | None, list[tuple[int, float, int]]]:
    """Word difficulties from the graded samples and, alternating, from all documents at their levels so far.

    Gives the model, all documents as rows (k, words, ids) of its table, and (round, log likelihood per word, words).
    A first pass scores the texts by the samples and adds up word counts by language and level, which meet in one small
    aggregation by word; words with enough counts, at most 1 / MIN_WORD_SHARE a language whatever the corpus, go to the
    driver. The share is one of the language's own words, so other languages and a larger corpus of the same kind don't
    change it. Then texts are read once more, into the table's rows with their counts, and all further rounds run over
    these; a word's difficulty is refitted on its own, from sums by word.
    """
    known = samples.where(f"text IS NOT NULL AND lang IS NOT NULL AND reading_level BETWEEN 1 AND {LEVELS}")
    anchors = _sample_counts(known.orderBy("sample_id").limit(MAX_SAMPLES).collect())
    model, told = Model(anchors), []
    if not anchors:
        return model, None, told
    counts = {lang: {w: c.copy() for w, c in by.items()} for lang, by in anchors.items()}
    if rounds:
        for r in _corpus_counts(docs, text, model).toLocalIterator():
            by = counts[r.lang]
            by[r.word] = by.get(r.word, 0) + np.array([r.c1, r.c2, r.c3, r.c4])
        model = Model(counts)
    rows = cut_lineage(encoded(docs, key, text, model))
    names = [None, *model.ids]
    before = -np.inf
    for turn in range(1, rounds):
        counts = {lang: {w: c.copy() for w, c in by.items()} for lang, by in anchors.items()}
        total = n = 0.0
        for r in _row_counts(rows, model).toLocalIterator():
            if r.id < 0:
                total, n = r.c1, r.c2
                continue
            by, w = counts[model.languages[r.j]], names[r.id]
            by[w] = by.get(w, 0) + np.array([r.c1, r.c2, r.c3, r.c4])
        told.append((turn, total / max(1.0, n), len(model.ids)))
        if told[-1][1] - before < TOLERANCE:
            break
        before = told[-1][1]
        model = Model(counts, names)
    return model, rows, told


def _corpus_counts(docs: DataFrame, text: str, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def f(_, texts):
            block = Words(texts)
            lang, p, _ = _weights(model.score(block.rows(model), block.sizes))
            owner = np.repeat(np.arange(len(texts)), block.sizes)
            out = {"lang": [], "word": []} | {f"c{k + 1}": [] for k in range(LEVELS)}
            for j, name in enumerate(model.languages):
                mask = ((lang == j) & (block.sizes >= MIN_WORDS))[owner]
                sums = _by_level(block.at[mask], owner[mask], p, len(block.words))
                there = np.flatnonzero(sums.sum(1)).tolist()
                out["lang"] += [name] * len(there)
                out["word"] += [block.words[i] for i in there]
                for k in range(LEVELS):
                    out[f"c{k + 1}"] += sums[there, k].tolist()
            return out

        return f

    parts = map_texts(docs.where(F.col(text).isNotNull()), [], text, "lang string, word string, c1 double, c2 double, c3 double, c4 double", make)
    words = parts.groupBy("lang", "word").agg(*(F.sum(f"c{k + 1}").alias(f"c{k + 1}") for k in range(LEVELS))).withColumn("n", F.expr("c1 + c2 + c3 + c4"))
    totals = words.groupBy("lang").agg(F.sum("n").alias("all_n"))
    return words.join(totals, "lang").where((F.col("n") >= MIN_COUNT) & (F.col("n") >= F.col("all_n") * MIN_WORD_SHARE))


def encoded(docs: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """(k, whole, words, ids) of each distinct document with a key: words between white space, words of its running text, and its rows of the model's table with how often it has them, as int32."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def f(keys, texts):
            at = [i for i, k in enumerate(keys[0]) if k is not None]
            block = Words([texts[i] for i in at])
            rows, out, start = block.rows(model), [], 0
            for n in block.sizes.tolist():
                ids, times = np.unique(rows[start : start + n], return_counts=True)
                known = ids > 0
                out.append(np.concatenate([ids[known], times[known]]).astype(np.int32).tobytes())
                start += n
            return {"k": [keys[0][i] for i in at], "whole": [len(texts[i].split()) for i in at], "words": block.sizes, "ids": out}

        return f

    return map_texts(docs.where(F.col(text).isNotNull()), [key], text, "k bigint, whole int, words int, ids binary", make)


def _decoded(binary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the table, how often, and how many different ones each document has."""
    parts = [np.frombuffer(x, np.int32) for x in binary.to_pylist()]
    sizes = np.array([len(x) // 2 for x in parts], np.int64)
    join = lambda half: np.concatenate([x[: len(x) // 2] if half == 0 else x[len(x) // 2 :] for x in parts]) if parts else np.zeros(0, np.int32)
    return join(0), join(1), sizes


def _row_counts(rows: DataFrame, model: Model) -> DataFrame:
    """(j, id, c1 to c4) by language and row of the table, summed in tasks first; id -1 has the log likelihood and the words of all documents."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        sums = np.zeros((len(model.languages), len(model.table), LEVELS))
        total = n = 0.0
        for batch in batches:
            words = batch.column("words").to_numpy()
            ids, times, sizes = _decoded(batch.column("ids"))
            lang, p, log = _weights(model.score(ids, sizes, times))
            owner, counted = np.repeat(np.arange(len(sizes)), sizes), words >= MIN_WORDS
            total, n = total + log[counted].sum(), n + times[counted[owner]].sum()
            for j in range(len(model.languages)):
                mask = ((lang == j) & counted)[owner]
                sums[j] += _by_level(ids[mask], owner[mask], p, len(model.table), times[mask])
        j, i = np.nonzero(sums.sum(2))
        c = sums[j, i]
        columns = [np.append(j, 0).astype(np.int32), np.append(i, -1).astype(np.int32), *(np.append(c[:, k], [total, n, 0, 0][k]) for k in range(LEVELS))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["j", "id", *(f"c{k + 1}" for k in range(LEVELS))])

    parts = rows.select("words", "ids").mapInArrow(run, "j int, id int, c1 double, c2 double, c3 double, c4 double")
    return parts.groupBy("j", "id").agg(*(F.sum(f"c{k + 1}").alias(f"c{k + 1}") for k in range(LEVELS)))


def levels(docs: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per distinct document of at least ``MIN_WORDS`` words: ``key``, lang, reading_level (1 to 4), margin.

    ``lang`` is the samples' language that explains the text best, margin the log-likelihood per word by which the level
    leads the next one. NULL texts and NULL keys give no row; ties go to the lower level; without samples every document
    gets level 1 and a NULL language. Whole texts are scored.
    """
    model, rows, _ = fit(docs, samples, key, text, rounds)
    if rows is None:
        rows = encoded(docs, key, text, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            words = np.maximum(1, batch.column("words").to_numpy())
            ids, times, sizes = _decoded(batch.column("ids"))
            ll = model.score(ids, sizes, times).reshape(len(sizes), -1, LEVELS)
            lang = ll.max(2).argmax(1)
            own = ll[np.arange(len(ll)), lang]
            order = np.sort(own, axis=1)
            names = [model.languages[j] for j in lang.tolist()] if model.languages else [None] * len(ll)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(names, pa.string()), pa.array((own.argmax(1) + 1).astype(np.int32)), pa.array((order[:, -1] - order[:, -2]) / words)], names=["k", "lang", "reading_level", "margin"])

    long = rows.where(F.col("whole") >= MIN_WORDS).select("k", "words", "ids")
    return long.mapInArrow(run, "k bigint, lang string, reading_level int, margin double").withColumnRenamed("k", key).distinct()


def likelihoods(docs: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(round, log_likelihood, words): the log likelihood per known word of all documents, before each refit, and the words with a difficulty."""
    _, _, told = fit(docs, samples, key, text)
    return docs.sparkSession.createDataFrame(told, "round int, log_likelihood double, words bigint")
