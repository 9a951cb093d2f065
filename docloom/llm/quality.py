"""Per-record text statistics and what they say of its kind (problem 6)."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.batches import map_texts
from docloom.llm.languages import code
from docloom.session import cut_lineage

#: Longer texts are measured in chunks of about so many characters, which meet again in groups of FAN.
CHUNK, FAN = 64_000, 16
#: A word is common if at least COMMON_SHARE of the records of some language (and COMMON_LEAST of them) hold it, or MOST_SHARE (and MOST_LEAST);
#: of some source's records without a language label, much of which may be junk, only by the latter.
COMMON_SHARE, COMMON_LEAST, MOST_SHARE, MOST_LEAST = 1e-3, 12, 0.05, 3
#: Beyond a heading, a list, table or junk record has at most so many sentences; a list or table has so many lines.
MOST_SENTENCES, LEAST_LINES = 1, 3
#: A record is without language if at most this share of its words of three letters or more is common.
#: or, in what is no table, of all its words and numbers.
JUNK_SHARE, BARE_SHARE = 0.2, 0.04

_WORD = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+")
_TOKEN = re.compile(r"\w+")
_PLAIN = re.compile(r"[\w\s]+")
_MARKED = re.compile(r"\s*(?:[-*+•–—·▪◦‣o](?:\s+\[[ xX]\])?|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])(?:\s|$)")
_HEADING = re.compile(r"\s*(?:#|\*{2,})")
_FORMULA = re.compile(r"\s*(?:\$\$|\\[a-zA-Z])")
_GAP = re.compile(r"\S(?:  +|\t)(?=\S)")
_FIELD = re.compile(r"[^;\n]{0,60};(?=\S|$)")
_ENDED = re.compile(r"[.!?…。？！][\"”’»)\]]*\s*$")
_SENTENCE = re.compile(r"[.!?…][\"”’»)\]]*(?=\s*$|\s+[^\s\da-zà-ÿα-ωа-я])|[。？！]")
_ONE_LETTER = re.compile(r"(.)\1*")


@dataclass
class Line:
    """What a line, or a piece of one, adds to its kind. Pieces of a line add up to the line."""

    head: str = ""
    tail: str = ""
    words: int = 0
    gaps: int = 0
    fields: int = 0
    cells: int = 0
    sentences: int = 0

    @staticmethod
    def of(text: str) -> Line:
        gaps = len(_GAP.findall(text)) if "  " in text or "\t" in text else 0
        fields = len(_FIELD.findall(text)) if ";" in text else 0
        return Line(text[:60], text[-40:], len(text.split()), gaps, fields, text.count("<tr") if "<" in text else 0, len(_SENTENCE.findall(text)))

    def add(self, right: Line) -> Line:
        head = self.head if len(self.head) == 60 else (self.head + right.head)[:60]
        return Line(head, (self.tail + right.tail)[-40:], *(getattr(self, n) + getattr(right, n) for n in ("words", "gaps", "fields", "cells", "sentences")))

    def block(self, sums: Counter) -> Block | None:
        """The line, now whole, as a block of one line; None if it is blank."""
        if not self.words:
            return None
        ended = bool(_ENDED.search(self.tail))
        sums["lines"] += 1
        sums["ended_lines"] += ended
        table = self.head.lstrip().startswith("|") or self.cells > 0 or "<td" in self.head or "\t" in self.head.strip() or not ended and (self.gaps >= 2 or self.fields >= 2)
        marked = not table and bool(_MARKED.match(self.head)) and not (ended and self.words > 8)
        heading = not table and not marked and bool(_HEADING.match(self.head))
        formula = not table and bool(_FORMULA.match(self.head))
        plain = not (table or marked or heading or formula)
        return Block(max(1, self.cells), marked, max(self.cells, table), heading, formula, ended and plain, max(self.sentences, ended) if plain else 0, self.words, self.words if plain else 0)


@dataclass
class Block:
    """Sums over consecutive lines without a blank line between them."""

    lines: int = 0
    marked: int = 0
    table: int = 0
    heading: int = 0
    formula: int = 0
    ended: int = 0
    sentences: int = 0
    words: int = 0
    longest: int = 0

    def add(self, o: Block) -> Block:
        return Block(self.lines + o.lines, self.marked + o.marked, self.table + o.table, self.heading + o.heading, self.formula + o.formula, self.ended + o.ended, self.sentences + o.sentences, self.words + o.words, max(self.longest, o.longest))


def close(b: Block | None, sums: Counter) -> None:
    """Book a whole block as table, list, heading, formula or prose."""
    if b is None:
        return
    body = b.lines - b.heading - b.formula
    if b.table and 2 * b.table >= body:
        sums["table_lines"] += body
    elif b.marked and 2 * b.marked >= body:
        sums["list_lines"] += b.lines
    elif body >= LEAST_LINES and not b.sentences and b.longest <= 12:
        sums["list_lines"] += body
    elif body == 0:
        pass
    elif body == 1 and not b.ended and b.words <= 8:
        sums["heading_lines"] += 1
    else:
        sums["prose_lines"] += body
        sums["sentences"] += max(1, b.sentences)


@dataclass
class Blocks:
    """A run of whole lines: the blocks at its borders stay open, those inside are booked."""

    head: Block | None = None
    broken: bool = False
    tail: Block | None = None

    def add(self, right: Blocks, sums: Counter) -> Blocks:
        join = lambda a, b: a.add(b) if a and b else a or b
        if not self.broken:
            return Blocks(join(self.head, right.head), right.broken, right.tail)
        if not right.broken:
            return Blocks(self.head, True, join(self.tail, right.head))
        close(join(self.tail, right.head), sums)
        return Blocks(self.head, True, right.tail)

    @staticmethod
    def line(block: Block | None) -> Blocks:
        return Blocks(block) if block else Blocks(broken=True)


@dataclass
class State:
    """Associative partial statistics of a piece of text; ``rest`` is None if the piece lies within one line.

    ``word_in``, ``word_out``: whether the piece's borders cut a word. ``first`` and ``last`` may be parts of lines.
    """

    sums: Counter = field(default_factory=Counter)
    first: Line = field(default_factory=Line)
    rest: Blocks | None = None
    last: Line | None = None
    word_in: bool = False
    word_out: bool = False

    def merge(self, right: State) -> State:
        """The statistics of this piece followed by ``right``."""
        sums = self.sums + right.sums
        if self.word_out and right.word_in:
            sums["words"] -= 1
        if self.rest is None:
            return State(sums, self.first.add(right.first), right.rest, right.last, self.word_in, right.word_out)
        joined = self.last.add(right.first)
        if right.rest is None:
            return State(sums, self.first, self.rest, joined, self.word_in, right.word_out)
        rest = self.rest.add(Blocks.line(joined.block(sums)), sums).add(right.rest, sums)
        return State(sums, self.first, rest, right.last, self.word_in, right.word_out)

    def finish(self) -> Counter:
        sums = Counter(self.sums)
        whole = Blocks.line(self.first.block(sums))
        if self.rest is not None:
            whole = whole.add(self.rest, sums).add(Blocks.line(self.last.block(sums)), sums)
        close(whole.head, sums)
        close(whole.tail, sums)
        return sums


def measure(text: str, common: frozenset, before: str = "", after: str = "") -> State:
    """Statistics of a piece of text; ``before`` and ``after`` are the characters beside it, '' at the text's ends."""
    s = State(word_in=bool(_TOKEN.match(before) and _TOKEN.match(text[:1])), word_out=bool(_TOKEN.match(after) and _TOKEN.match(text[-1:])))
    sums = s.sums
    words = _WORD.findall(text.lower())
    long = [w for w in words if len(w) > 2 or "㐀" <= w[0] <= "鿿"]
    sums["chars"] = len(text)
    sums["words"] = len(_TOKEN.findall(text))
    sums["letters"] = sum(map(len, words))
    sums["symbols"] = len(_PLAIN.sub("", text))
    sums["long_words"] = len(long)
    sums["common_words"] = sum(1 for w in long if w in common or "㐀" <= w[0] <= "鿿")
    sums["foreign"] = sum(1 for w in words if not w.isascii())
    lines = [Line.of(x) for x in text.split("\n")]
    s.first = lines[0]
    if len(lines) > 1:
        rest, block = Blocks(), None
        for line in lines[1:-1]:
            one = line.block(sums)
            if one:
                block = block.add(one) if block else one
            else:
                rest = rest.add(Blocks(block, True), sums)
                block = None
        s.rest, s.last = rest.add(Blocks(block), sums), lines[-1]
    return s


_SAFE = re.compile(r"\w (?=\S)")


def cut(text: str, size: int = CHUNK) -> list[int]:
    """Borders of a text's chunks: at a line's start, else after a word and one space, as near to ``size`` as there is one."""
    at = [0]
    while len(text) - at[-1] > size:
        low, high = at[-1] + size // 2, at[-1] + size
        border = text.rfind("\n", low, high) + 1
        if not border:
            safe = _SAFE.search(text, low, high) or _SAFE.search(text, high)
            line = text.find("\n", high) + 1
            border = min((x for x in (safe.end() if safe else 0, line) if x), default=len(text))
        if border >= len(text):
            break
        at.append(border)
    return [*at, len(text)]


#: Begins the names of groups of records without a language label.
FROM = "from "


def _group(label: str | None, source: str | None) -> str:
    """The language that a record's label means; records without one count with those of their source."""
    return code(label) or f"{FROM}{source}"


def common_words(docs: DataFrame, text: str, lang: str, source: str) -> frozenset:
    """Words in at least ``COMMON_SHARE`` of the records of some language, or ``MOST_SHARE`` of some source's records without a language label.

    Each group counts by itself, so that a rare language has its common words beside any number of records of others; at
    most (words a record) / COMMON_SHARE words a group reach the driver, whatever the corpus.
    """

    def make():
        def f(keys, texts):
            sums: Counter = Counter()
            for label, own, t in zip(*keys, texts, strict=True):
                group = _group(label, own)
                sums[group, ""] += 1
                sums.update({(group, w) for w in _WORD.findall(t.lower()) if len(w) > 2 and not _ONE_LETTER.fullmatch(w)})
            return {"group": [g for g, _ in sums], "word": [w for _, w in sums], "n": list(sums.values())}

        return f

    have = [F.col(c).cast("string").alias(n) if c in docs.columns else F.lit(None).cast("string").alias(n) for c, n in ((lang, "label"), (source, "own"))]
    rows = docs.where(F.col(text).isNotNull()).select(*have, F.col(text).alias("whole"))
    # used twice, read and counted once
    counts = cut_lineage(map_texts(rows, ["label", "own"], "whole", "group string, word string, n bigint", make).groupBy("group", "word").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("group").agg(F.max(F.when(F.col("word") == "", F.col("n"))).alias("records"))
    most = F.greatest(F.lit(MOST_LEAST), F.col("records") * MOST_SHARE)
    least = F.when(F.col("group").startswith(FROM), most).otherwise(F.least(most, F.greatest(F.lit(COMMON_LEAST), F.col("records") * COMMON_SHARE)))
    return frozenset(r.word for r in counts.join(totals, "group").where((F.col("word") != "") & (F.col("n") >= least)).select("word").distinct().toLocalIterator())


NUMBERS = ("chars", "words", "letters", "symbols", "lines", "ended_lines", "long_words", "common_words", "foreign", "list_lines", "table_lines", "heading_lines", "prose_lines", "sentences")


def _partials(docs: DataFrame, key: str, text: str, common) -> tuple[DataFrame, DataFrame]:
    """(k, h, chunk, pieces, state) of whole texts and of the chunks of huge ones, which are dealt out, each once, before they are measured; ``h`` tells texts of one key apart."""

    def split():
        def f(keys, texts):
            out = {"k": [], "h": [], "chunk": [], "pieces": [], "before": [], "piece": [], "after": []}
            for k, h, t in zip(*keys, texts, strict=True):
                at = cut(t)
                for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    for n, v in zip(out, (k, h, i, len(at) - 1, t[a - 1 : a] if a else "", t[a:b], t[b : b + 1]), strict=True):
                        out[n].append(v)
            return out

        return f

    def make():
        words = common.value

        def f(keys, texts):
            k, h, chunk, pieces, before, after = keys
            states = [pickle.dumps(measure(t, words, b, a)) for t, b, a in zip(texts, before, after, strict=True)]
            return {"k": k, "h": h, "chunk": chunk, "pieces": pieces, "state": states}

        return f

    schema = "k bigint, h bigint, chunk bigint, pieces bigint, state binary"
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("piece"))
    small = F.coalesce(F.length("piece"), F.lit(0)) <= CHUNK
    single = rows.where(small).select("k", "h", F.lit(0).cast("bigint").alias("chunk"), F.lit(1).cast("bigint").alias("pieces"), F.lit("").alias("before"), F.lit("").alias("after"), "piece")
    huge = map_texts(rows.where(~small), ["k", "h"], "piece", "k bigint, h bigint, chunk bigint, pieces bigint, before string, piece string, after string", split).repartition("k", "h", "chunk")
    keys = ["k", "h", "chunk", "pieces", "before", "after"]
    return map_texts(single, keys, "piece", schema, make), map_texts(huge, keys, "piece", schema, make).dropDuplicates(["k", "h", "chunk"])


def statistics(docs: DataFrame, key: str = "ext_id", text: str = "markdown", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per distinct record with a key: counts, ratios and is_list, is_table, is_junk.

    Columns: ``key``, the counts of ``NUMBERS``, mean_word_length, symbol_ratio, ended_line_share, common_word_share.
    NULL and empty texts have zero counts, NULL ratios and no kind. Texts beyond ``CHUNK`` characters are cut, measured
    piece by piece and merged in groups of ``FAN``; a state remembers whether its borders cut a word, line or block, so
    the merged numbers are those of the whole text. A table without the columns ``lang`` and ``source`` is one group
    of common words.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_words(docs, text, lang, source))
    whole, chunks = _partials(docs.where(F.col(key).isNotNull()), key, text, common)

    def merged(rows: pa.Table) -> pa.Table:
        order = rows.sort_by("chunk").to_pylist()
        states = [pickle.loads(r["state"]) for r in order]
        while len(states) > 1:
            states = [states[i].merge(states[i + 1]) if i + 1 < len(states) else states[i] for i in range(0, len(states), 2)]
        first = order[0]
        return pa.table({n: [first[n]] for n in ("k", "h", "chunk", "pieces")} | {"state": [pickle.dumps(states[0])]}, schema=pa.schema([*((n, pa.int64()) for n in ("k", "h", "chunk", "pieces")), ("state", pa.binary())]))

    schema = "k bigint, h bigint, chunk bigint, pieces bigint, state binary"
    tier = chunks.groupBy("k", "h", F.floor(F.col("chunk") / FAN)).applyInArrow(merged, schema).groupBy("k", "h").applyInArrow(merged, schema)
    states = whole.select("k", "state").unionByName(tier.select("k", "state"))

    def finish(batches):
        for batch in batches:
            keys, sums = batch.column(0), [pickle.loads(x).finish() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([keys, *(pa.array([s[n] for s in sums], pa.int64()) for n in NUMBERS)], names=["k", *NUMBERS])

    rows = states.mapInArrow(finish, "k bigint, " + ", ".join(f"{n} bigint" for n in NUMBERS)).distinct()
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    few = F.col("sentences") <= MOST_SENTENCES
    junk = (F.col("chars") > 20) & (F.col("words") + F.col("symbols") > 0) & ((F.col("common_words") <= JUNK_SHARE * F.col("long_words")) | (F.col("common_words") <= BARE_SHARE * F.col("words")) & (F.col("table_lines") == 0)) & (F.col("foreign") * 10 <= F.col("words"))
    return (
        rows.withColumn("mean_word_length", share("letters", "words"))
        .withColumn("symbol_ratio", share("symbols", "chars"))
        .withColumn("ended_line_share", share("ended_lines", "lines"))
        .withColumn("common_word_share", share("common_words", "long_words"))
        .withColumn("is_junk", junk)
        .withColumn("is_list", ~junk & few & (F.col("list_lines") >= LEAST_LINES))
        .withColumn("is_table", ~junk & few & (F.col("table_lines") >= LEAST_LINES))
        .withColumnRenamed("k", key)
    )


def miscounted(docs: DataFrame, results: DataFrame) -> DataFrame:
    """ext_id of records for which some result row gives another number of characters (NULL text and NULL count: 0)."""
    texts = docs.select("ext_id", "sha256", "backend", F.coalesce(F.length("markdown"), F.lit(0)).cast("bigint").alias("n"))
    told = results.select("sha256", F.col("extract_backend").alias("backend"), F.coalesce("markdown_chars", F.lit(0).cast("bigint")).alias("told")).distinct()
    return texts.join(told, ["sha256", "backend"]).where("n != told").select("ext_id").distinct()


def kinds(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Rows (ext_id, kind): 'list', 'table', 'junk' by the statistics, 'miscounted' by the results; prose has no row."""
    found = statistics(docs).select("ext_id", F.explode(F.array_compact(F.array(*(F.when(F.col(f"is_{k}"), k) for k in ("list", "table", "junk"))))).alias("kind"))
    return found.unionByName(miscounted(docs, results).withColumn("kind", F.lit("miscounted")))
