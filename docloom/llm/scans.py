"""Noise in text from scanned pages: found by confusable-glyph skeletons, masked digits and line shapes (problem 2)."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.batches import map_texts
from docloom.llm.languages import code
from docloom.session import cut_lineage

#: A form is a misreading of a word with its skeleton that is so many times as frequent in the language (and at least so frequent).
RATIO, MATE = 25, 40
#: Parts of glued words, halves of divided words have at least this count and this share of the language's words.
PART, PART_SHARE = 12, 2e-5
#: Words below this count don't reach the driver, whatever the corpus; in judgements their count is the most that it can be.
MIN_COUNT = 2
#: A form with so many uses is a misreading only if this share of them has a neighbour that its mate has on that side as well.
USES, SUPPORTED = 4, 0.3
#: A header's masked form stands on so many lines of some source (and on so many for each of its records), so often on its own.
HEADER_COUNT, HEADER_SHARE, HEADER_ALONE = 4, 1e-3, 0.25
#: A word with less than this share of its uses in one language is a name; a word in this share of all short lines by themselves is part of headers.
NAME_SHARE, HEAD_SHARE = 0.6, 0.01
#: Keys of the counts of lower-case uses and of words in short lines by themselves, beside those of languages.
LOWER, HEADS = "_", "^"

#: Glyphs that scanning confuses, written as the sign of their class; pairs read as one glyph come first.
PAIRS = (("rn", "m"), ("vv", "w"), ("cl", "d"), ("ii", "ü"))
CLASSES = str.maketrans("aoec0" + "ijl1tf|!" + "hb6ß8" + "un" + "s5" + "g9q", "o" * 5 + "l" * 8 + "h" * 5 + "n" * 2 + "s" * 2 + "g" * 3)
#: Digits as the letters that they are read for.
DIGITS = (str.maketrans("01569", "olsbg"), str.maketrans("0158", "oisb"))

_HYPHEN = "-‐¬­"
_PLAIN = re.compile("[A-Za-zß-öø-ÿÀ-ÖØ-ÞĀ-ž0-9]+|[Ά-ώ0-9]+|[А-яЁё0-9]+")
_LATIN = re.compile("[a-zß-öø-ÿĀ-ž]+")
_EDGES = "\"'`.,;:!?()[]{}<>“”‘’„‚«»…*#_~|·•–—/"
_ENDED = re.compile(r"[.!?…。？！][\"”’»)\]]*\s*$")
_MARKED = re.compile(r"\s*(?:[-*+•–—·▪◦‣o](?:\s+\[[ xX]\])?|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)])\s")
_FIELDS = re.compile(r";\S.*;")
_INSIDE = re.compile(r"[.!?…][\"”’»)]* \S")
_BLANK = re.compile(r"\n[ \t]*\n\s*")
_HEADER_SIGNS = re.compile(r"(?:[^\W_]|[ .,:&—–'-])+")
_INNER = re.compile("([^\\W\\d_]*[a-zß-öø-ÿα-ωа-я]{2})([A-ZА-Я][a-zß-öø-ÿα-ωа-я]{2,})")
_SPECKS = ("~", "·", "'", "`", "^", " . ", " , ")
_DIVIDED = re.compile(rf"([^\W\d_]+)[{_HYPHEN}]\s*\n(?:[^\n]{{0,70}}\n)?\s*([^\W\d_]+)")
_DIVIDED_LOST = re.compile(rf"([^\W\d_]+)([{_HYPHEN}] ?)([^\W\d_]+)")
_HANGING = re.compile(rf"[^\W\d_]{{2,}}[{_HYPHEN}]\s*$")
_SPACED = re.compile(r"(?<!\S)(?:(?:[^\W\d_][ \n]){3,}[^\W\d_](?![^\W\d_])|(?:\d[ \n]){2,}\d(?!\S))")
_SPACED_SHORT = re.compile(r"(?<!\S)(?:[^\W\d_] ){2}[^\W\d_](?!\S)|\( ?[A-Za-z] [a-z] [a-z]? ?\.|\([A-Za-z]+\. \d \d ?\)")
_SPECK = re.compile(r"(?<=[^\s|])[ \n][~·'`^¨°.,][ \n](?=[^\s|])|(?<!\S)[~·'`^] (?=[^\W_]{2,})|(?<=[^\W_]{2}) [~·'`^](?=\n|$)")
_N = r"(?=[lIOS]*\d)[\dlIOS]{1,4}"
_NUMBER = re.compile(rf"\s*(?:{_N}|\[{_N}\]|{_N} ?/ ?{_N}|[-–—~] ?{_N} ?[-–—~]|(?:[Pp][ao0]g[ec]|p\.|[Ss]eite|S\.) ?{_N}|m{{0,3}}(?:c[md]|d?c{{0,3}})(?:x[cl]|l?x{{0,3}})(?:i[xv]|v?i{{0,3}})(?<=[ivxlcdm]))\s*$")
_WORD = re.compile(r"[^\W\d_]+")
_NUMBER_WORD = re.compile(r"(\d+)([^\W\d_]{3,})|([^\W\d_]{3,})(\d+)")


def skeleton(word: str) -> str:
    """The word with confusable glyphs made one: misreadings keep their word's skeleton."""
    word = word.lower()
    for pair, one in PAIRS:
        word = word.replace(pair, one)
    return word.translate(CLASSES)


class _Memo(dict):
    """A bounded cache of a function of one string."""

    def __init__(self, f):
        super().__init__()
        self.f = f

    def __missing__(self, key):
        if len(self) > 300_000:
            self.clear()
        value = self[key] = self.f(key)
        return value


def bare(raw: str) -> str:
    """A white-space token without punctuation; '' if it isn't letters and digits of plain scripts."""
    token = raw.strip(_EDGES)
    return token if _PLAIN.fullmatch(token) else ""


class Words:
    """Frequent words of each language, by form and by skeleton."""

    def __init__(self, counts: dict[str, Counter]):
        counts = dict(counts)
        lower, heads = counts.pop(LOWER, Counter()), counts.pop(HEADS, Counter())
        self.counts = {lang: c for lang, c in counts.items() if c}
        self.part = {lang: max(PART, PART_SHARE * sum(c.values())) for lang, c in self.counts.items()}
        self.mates: dict[str, dict[str, tuple[str, int]]] = {}
        self.total: Counter = Counter()
        best: dict[str, tuple[int, str]] = {}
        for lang, c in self.counts.items():
            mates = self.mates[lang] = {}
            self.total.update(c)
            for w, n in c.items():
                if n >= MATE and not any(x.isdigit() for x in w):
                    s = skeleton(w)
                    if mates.get(s, ("", 0))[1] < n:
                        mates[s] = (w, n)
                if n > best.get(w, (0, ""))[0]:
                    best[w] = (n, lang)
        #: Forms used often enough to have contexts, with the word that they may be misread from.
        self.contested = {lang: {w: m[0] for w, n in c.items() if n >= USES and w.isalpha() and (m := self.mates[lang].get(skeleton(w))) and m[0] != w and m[1] >= RATIO * (n + 1)} for lang, c in self.counts.items()}
        #: Of these, the ones whose neighbours are not those of that word: words of their own.
        self.unsupported: set[tuple[str, str]] = set()
        self.mates_of = {lang: set(by.values()) for lang, by in self.contested.items()}
        self.home = {w: lang for w, (n, lang) in best.items() if n >= PART and len(w) > 1 and w.isalpha()}
        # names stand in texts of all languages, and never in lower case; words that many headers share are kept
        own = {w for w in self.home if 2 * lower[w] >= self.total[w] or best[w][0] >= NAME_SHARE * self.total[w]}
        self.literal = own | {w for w, n in heads.items() if n >= max(HEADER_COUNT, HEAD_SHARE * heads[""])}

    def near(self, word: str) -> str:
        """Language of the frequent word that an unknown one is likely misread from; '' if there is none."""
        if len(word) < 4 or len(set(word)) < 3 or word in self.home or word.isdigit():
            return ""
        s = skeleton(word)
        found = [(m[s][1], lang) for lang, m in self.mates.items() if s in m]
        return max(found)[1] if found else ""

    def judge(self, token: str, lang: str) -> tuple[str, str] | None:
        """('misread', word), ('name', word) where that may be a name instead, ('glued', words) or None."""
        c, part = self.counts[lang], self.part[lang]
        low = token.lower()
        own, mate = c[low] or MIN_COUNT - 1, self.mates[lang].get(skeleton(low))
        if any(x.isdigit() for x in token):
            return None if low.isdigit() else self._digits(low, own, mate, c, part)
        capital = token[0].isupper()
        # all languages' uses count: a word of another language is no misreading
        other = self.home.get(low, lang)
        if other != lang and self.counts[other][low] >= 10 * self.part[other]:
            return None
        if mate and mate[0] != low and (lang, low) not in self.unsupported and mate[1] >= RATIO * (own + 1) and self.total[mate[0]] >= RATIO * max(own, self.total[low]) and len(low) > 1 + capital:
            return "name" if capital and (lang != "de" or len(low) < 7) else "misread", mate[0]
        if (self.total[low] - own) * 4 >= own + 2:  # a word of another language, or a name, which all languages have
            return None
        if own * 4 < part and len(low) > 4:
            if capital and c[low[0]] >= 30 * part and c[low[1:]] >= 4 * part and not self.total[low]:
                return "glued", f"{token[0]} {token[1:]}"
            for i in range(3 if capital else 1, len(low) - 1):
                short = min(i, len(low) - i)
                least = part * (30 if short < 3 else 4 if capital else 1)
                if c[low[:i]] >= least and c[low[i:]] >= least and (short > 2 or not capital):
                    return "glued", f"{token[:i]} {token[i:]}"
        inner = _INNER.fullmatch(token)
        if inner and own < part and c[inner[1].lower()] >= part:
            return "glued", f"{inner[1]} {inner[2]}"
        return None

    def _digits(self, low: str, own: int, mate, c: Counter, part: float) -> tuple[str, str] | None:
        for table in DIGITS:
            word = low.translate(table)
            if len(word) > 1 and word.isalpha() and c[word] >= MATE and c[word] >= RATIO * own:
                return "misread", word
        if mate and len(low) > (3 if low[0].isdigit() else 2):
            return "misread", mate[0]
        m = _NUMBER_WORD.fullmatch(low)
        if m and c[m[2] or m[3]] >= part:
            return "glued", f"{m[1] or m[3]} {m[2] or m[4]}"
        return None


def mask(line: str, literal: set) -> str:
    """A line with numbers as # and words that are no part of headers or language as @; the others as they are."""

    def one(m: re.Match) -> str:
        return "#" if m[0].isdigit() else m[0] if m[0].lower() in literal else "@"

    return re.sub(r"[^\W_]+", one, line.strip())


def _form_pattern(form: str) -> str:
    """A pattern for lines of a masked form: any capitalized word for @, a number (or part of one misread) for #."""
    parts = re.split(r"([@#])", re.sub(r"^#\s+|\s+#$", "", form))
    return "".join({"@": r"(?:[^\W\d_a-zß-ÿ]|[\dl])[^\W_]*", "#": _N}.get(x, re.escape(x)) for x in parts)


def _header_like(line: str) -> bool:
    return 8 <= len(line) <= 60 and line.count(" ") <= 8 and bool(_HEADER_SIGNS.fullmatch(line)) and (line.isupper() or not _ENDED.search(line)) and not _MARKED.match(line)


class Pages:
    """Judges whole records: the words of the corpus and its headers' masked forms."""

    def __init__(self, words: Words, headers: frozenset):
        self.words, self.headers = words, headers
        home = words.home
        forms = sorted({_form_pattern(f) for f in headers})
        self.own = {skeleton(w): w for form in headers for w in _WORD.findall(form)}
        #: A fixed word of each form: prose without any of these has no header inside.
        self.fixed = re.compile("|".join(re.escape(w) for w in sorted({max(_WORD.findall(f.replace("@", " ")), key=len) for f in headers}, key=len, reverse=True)) or "(?!)")
        self.inline = re.compile("(?<!\\S)(?:" + "|".join(forms) + ")(?!\\S)" if forms else "(?!)")
        self.line = re.compile(rf"(?:{_N}\s+)?(?:{'|'.join(forms)})(?:\s+{_N})?" if forms else "(?!)")
        self.homes = _Memo(lambda raw: home.get(bare(raw).lower(), "" if bare(raw) and not bare(raw).isdigit() else None))
        self.near = _Memo(lambda raw: words.near(bare(raw).lower()))
        self.verdicts = {lang: _Memo(lambda raw, lang=lang: words.judge(bare(raw), lang) if bare(raw) else None) for lang in words.counts}

    def __reduce__(self):
        return Pages, (self.words, self.headers)

    def header(self, line: str) -> bool:
        """Whether a line has a header's form, its fixed words perhaps misread."""
        if not _header_like(line):
            return False
        line = line.strip()
        if self.line.fullmatch(line):
            return True
        mended = re.sub(r"[^\W_]+", lambda m: self.own.get(skeleton(m[0]), m[0]), line)
        return mended != line and self.line.fullmatch(mended) is not None

    def traces(self, text: str, first: bool = False) -> list[tuple[str, str, str]]:
        """(kind, as seen, mended) of each trace; with ``first``, only until there is one."""
        found: list[tuple[str, str, str]] = []
        for _, block in self.blocks(text):
            self.block(block, found, first)
            if first and found:
                break
        return found

    @staticmethod
    def blocks(text: str):
        """(gap before, block) of the blocks between blank lines."""
        at = 0
        for m in _BLANK.finditer(text):
            if m.start() > at:
                yield at, text[at : m.start()]
            at = m.end()
        if at < len(text) and text[at:].strip():
            yield at, text[at:].rstrip("\n")

    def block(self, block: str, found: list, first: bool = False) -> list[str] | None:
        """Add the traces in a block; the lines of its prose, or None if it is no prose or has no trace."""
        lines = block.split("\n")
        if len(lines) == 1 and len(block) <= 60:
            kind = "page number" if _NUMBER.match(block) else "header" if self.header(block) else ""
            if kind:
                found.append((kind, block, ""))
                return []
        homes = Counter(map(self.homes.__getitem__, block.split()))
        del homes[None]
        unknown = homes.pop("", 0)
        known = sum(homes.values())
        if known < 2 or known * 2 < unknown:  # misread throughout, or junk, formulas, wrongly decoded text
            near = Counter(map(self.near.__getitem__, block.split()))
            near.pop("", None)
            homes.update(near)
            near_known = sum(homes.values())
            if near_known < 3 or near_known * 2 < unknown + known:
                return None
            known = near_known
        lang = max(homes, key=lambda k: (homes[k], k))
        kinds = [""] * len(lines)
        if len(lines) > 1:
            kinds = ["page number" if len(x) < 20 and x.strip() and _NUMBER.match(x) else "header" if len(x) <= 60 and self.header(x) else "" for x in lines]
        kept = [x for x, k in zip(lines, kinds, strict=True) if not k]
        shaped = sum(_apart(x) for x in kept)
        if shaped * 2 >= len(kept) and kept:
            return None
        prose = "\n".join(kept)
        hanging = bool(_HANGING.search(prose))
        if not hanging and not _sentence(kept) and (len(kept) > 1 or known < 4):
            return None
        before = len(found)
        found.extend((k, line, "") for k, line in zip(kinds, lines, strict=True) if k)
        if len(kept) > 1:
            found.append(("line break", "", " "))
        if hanging:
            found.append(("divided", prose[-12:], ""))
        if first and len(found) > before:
            return kept
        if self.fixed.search(prose):
            found.extend(("header", m[0], "") for m in self.inline.finditer(prose))
        counts, part = self.words.counts[lang], self.words.part[lang]
        if len(kept) > 1:
            found.extend(("divided", m[0], m[1] + m[2]) for m in _DIVIDED.finditer(prose))
        if any(h in prose for h in _HYPHEN):
            for m in _DIVIDED_LOST.finditer(prose):
                a, b, hyphen = m[1].lower(), m[3].lower(), m[2]
                whole = counts[a + b] >= part and (" " in hyphen or "\xad" not in hyphen) and not (counts[a] >= 10 * part and counts[b] >= 10 * part)
                cut = " " in hyphen and hyphen[0] != "\xad" and len(a) > 1 and counts[a] < part and m[3][0].islower() and _LATIN.fullmatch(a + b)
                if whole or cut:
                    found.append(("divided", m[0], m[1] + m[3]))
        tokens = prose.split()
        if sum(len(t) == 1 for t in tokens) > 2:
            found.extend(("spaced", m[0], re.sub(r"\s", "", m[0])) for m in _SPACED.finditer(prose))
            found.extend(("spaced", m[0], m[0].replace(" ", "")) for m in _SPACED_SHORT.finditer(prose) if m[0].startswith("(") or counts[m[0].replace(" ", "").lower()] >= part)
        if any(x in prose for x in _SPECKS):
            found.extend(("speck", m[0], " ") for m in _SPECK.finditer(prose))
        if first and len(found) > before:
            return kept
        verdicts = list(map(self.verdicts[lang].__getitem__, tokens))
        if any(verdicts):
            start = True
            for raw, verdict in zip(tokens, verdicts, strict=True):
                if verdict and (verdict[0] != "name" or counts[verdict[1]] >= 10 * MATE * (self.words.total[bare(raw).lower()] + 1) and (start or lang == "de" and len(found) > before)):
                    found.append(("misread" if verdict[0] == "name" else verdict[0], raw, verdict[1]))
                    if first:
                        return kept
                start = bool(_ENDED.search(raw))
        return kept if len(found) > before else None


def _apart(line: str) -> bool:
    """Whether a line is a heading, list item, table row or formula."""
    return line.lstrip().startswith(("#", "**", "|", "<t", "$$", "\\")) or "\t" in line.strip() or "<td" in line or line.count("   ") > 1 and not _sentence([line]) or line.count(";") > 1 and bool(_FIELDS.search(line)) or bool(_MARKED.match(line))


def _sentence(lines: list[str]) -> bool:
    return any(_ENDED.search(x[-12:]) or _INSIDE.search(x) for x in lines)


def mend(pages: Pages, text: str) -> str:
    """The text as continuous paragraphs: without headers, page numbers and specks, with words and lines made whole."""
    out = []
    for _, block in pages.blocks(text):
        found: list[tuple[str, str, str]] = []
        kept = pages.block(block, found)
        if kept is not None:
            block = _flow(kept, found)
        if block:
            out.append(block)
    return "\n\n".join(out)


def _flow(lines: list[str], found: list[tuple[str, str, str]]) -> str:
    text = ""
    for line in lines:
        line = line.strip()
        if text and text[-1] in _HYPHEN and len(text) > 1 and text[-2].isalpha() and line[:1].isalpha():
            text = text[:-1] + line
        else:
            text = f"{text} {line}" if text and line else text or line
    words = {}
    for kind, seen, mended in found:
        if kind in ("spaced", "speck"):
            text = text.replace(seen.replace("\n", " "), mended)
        elif kind == "header" and seen not in lines:
            text = text.replace(seen.replace("\n", " "), "")
        elif kind == "divided" and mended and "\n" not in seen:
            text = text.replace(seen, mended)
        elif kind in ("misread", "glued"):
            words[seen] = mended
    if not words:
        return text

    def one(m: re.Match) -> str:
        if m[0] not in words:
            return m[0]
        core = m[0].strip(_EDGES)
        mended = words[m[0]]
        if core.isupper() and len(core) > 1:
            mended = mended.upper()
        elif core[:1].isupper():
            mended = mended[:1].upper() + mended[1:]
        return m[0].replace(core, mended)

    return re.sub(r"\S+", one, text)


#: Segments of a document are windowed in runs of so many.
RUN = 512


def mended_records(docs: DataFrame, key: str, text: str, pages) -> DataFrame:
    """Per distinct record with a trace: ``key`` and mended, its text made continuous; ``pages`` is a broadcast ``Pages``."""

    def make():
        model = pages.value

        def f(keys, texts):
            hit = [(k, mend(model, t)) for k, t in zip(keys[0], texts, strict=True) if k is not None and model.traces(t, first=True)]
            return {"k": [k for k, _ in hit], "mended": [t for _, t in hit]}

        return f

    return map_texts(docs, [key], text, "k bigint, mended string", make).withColumnRenamed("k", key).distinct()


def paragraphs(segments: DataFrame, pages, run: int = RUN) -> DataFrame:
    """Per distinct segment: seg_id, mended, para_id (the seg_id of the segment that its paragraph begins in).

    A segment goes on from the one before it in its document, headers and page numbers aside, if that ends within a word
    or sentence and this begins in lower case. Windows run over ``run`` segments of a document at a time, so a document
    that holds much of the table is many windows; what the runs before it leave open, one row a run, goes over to the next.
    """

    def make():
        model = pages.value

        def f(keys, texts):
            return {"sha256": keys[0], "backend": keys[1], "seg_index": keys[2], "seg_id": keys[3], "mended": [mend(model, t) for t in texts]}

        return f

    keys = ["sha256", "backend", "seg_index", "seg_id"]
    rows = map_texts(segments.where("seg_id IS NOT NULL"), keys, "content", "sha256 string, backend string, seg_index int, seg_id bigint, mended string", make)
    return joined(cut_lineage(rows.dropDuplicates(["seg_id"])), run)


def joined(rows: DataFrame, run: int = RUN) -> DataFrame:
    """seg_id, mended and para_id of rows (sha256, backend, seg_index, seg_id, mended), see ``paragraphs``."""
    doc = ["sha256", "backend"]
    order = Window.partitionBy(*doc, "run").orderBy("seg_index", "seg_id")
    kept = F.when(F.col("mended") != "", F.col("mended"))
    ends = lambda text: ~text.rlike(r"[.!?…。？！:;][\"”’»)\]]*\s*$")
    goes_on = lambda before, text: before.isNotNull() & ends(before) & text.rlike(r"^\p{Ll}")
    before = F.last(kept, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    every = rows.withColumn("run", F.floor(F.coalesce("seg_index", F.lit(-1)) / run)).withColumn("before", before)
    # within a run, the heads that don't depend on the runs before; its first kept segment may go on from these
    every = every.withColumn("first", kept.isNotNull() & F.col("before").isNull()).withColumn("head", F.when(kept.isNotNull() & F.col("before").isNotNull() & ~goes_on(F.col("before"), kept), F.col("seg_id")))
    every = every.withColumn("head", F.last("head", ignorenulls=True).over(order))
    # one row a run: its first kept text, its last one and its last head
    place = F.struct("seg_index", "seg_id")
    own = every.where(kept.isNotNull()).groupBy(*doc, "run").agg(F.min_by("seg_id", place).alias("first_id"), F.min_by("mended", place).alias("first_text"), F.max_by("mended", place).alias("last_text"), F.max_by("head", place).alias("last_head"))
    runs = Window.partitionBy(*doc).orderBy("run")
    carried = F.last("last_text").over(runs.rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("begins", F.when(~F.coalesce(goes_on(carried, F.col("first_text")), F.lit(False)), F.col("first_id")))
    own = own.withColumn("left", F.last(F.coalesce("last_head", "begins"), ignorenulls=True).over(runs.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.select(*(F.col(c).alias(f"own_{c}") for c in [*doc, "run"]), F.coalesce("begins", "left").alias("open"))
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in [*doc, "run"]]
    para = F.when(kept.isNotNull(), F.coalesce("head", "open"))
    return every.join(own, same, "left").select("seg_id", "mended", F.coalesce(para, F.col("seg_id")).alias("para_id"))


def _alone(text: str):
    """Lines that may be headers and whether they stand between blank lines."""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if line and _header_like(line):
            yield line, not (i and lines[i - 1].strip()) and not (i + 1 < len(lines) and lines[i + 1].strip())


def count_words(texts: list[str], labels: list[str | None], bares: _Memo) -> Counter:
    """Counts by (language of the label, word), lower-case uses by (LOWER, word), words of short lines by themselves by (HEADS, word)."""
    raw: dict[str, Counter] = defaultdict(Counter)
    sums: Counter = Counter()
    for label, t in zip(labels, texts, strict=True):
        raw[code(label) or ""].update(t.split())
        for line, alone in _alone(t):
            if alone:
                sums[HEADS, ""] += 1
                sums.update({(HEADS, w.lower()) for w in _WORD.findall(line)})
    for own, counts in raw.items():
        for token, n in counts.items():
            w = bares[token]
            if w:
                low = w.lower()
                if own:
                    sums[own, low] += n
                if low == w:
                    sums[LOWER, low] += n
    return sums


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n) of ``count_words`` over all records; summed in tasks first."""

    def make():
        bares = _Memo(bare)

        def f(keys, texts):
            sums = count_words(texts, keys[0], bares)
            return {"lang": [k[0] for k in sums], "word": [k[1] for k in sums], "n": list(sums.values())}

        return f

    parts = map_texts(docs.where(F.col(text).isNotNull()), [lang], text, "lang string, word string, n bigint", make)
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class _Contexts:
    """Counts the neighbours, by their skeletons, of contested forms; of the words that they may be misread from it notes each neighbour of a side once a task."""

    #: Notes beyond so many are forgotten, and so may be made again.
    MOST = 1_000_000

    def __init__(self, words: Words):
        self.words = words
        self.roles = {lang: _Memo(lambda raw, lang=lang: self._role(raw, lang)) for lang, forms in words.contested.items() if forms}
        self.near = _Memo(lambda raw: skeleton(bare(raw)) or None)
        self.noted: set = set()

    def _role(self, raw: str, lang: str) -> tuple[str, str] | None:
        w = bare(raw).lower()
        return ("form", w) if w in self.words.contested[lang] else ("mate", w) if w in self.words.mates_of[lang] else None

    def add(self, text: str, label: str | None, sums: Counter) -> None:
        lang = code(label) or ""
        roles = self.roles.get(lang)
        if roles is None:
            return
        raw, near, noted = text.split(), self.near, self.noted
        if len(noted) > self.MOST:
            noted.clear()
        for i, role in enumerate(map(roles.__getitem__, raw)):
            if role is None:
                continue
            a, b = near[raw[i - 1]] if i else None, near[raw[i + 1]] if i + 1 < len(raw) else None
            if role[0] == "form":
                if a or b:
                    sums["form", lang, role[1], a, b] += 1
                continue
            for key in ((lang, role[1], a, None), (lang, role[1], None, b)):
                if (key[2] or key[3]) and key not in noted:
                    noted.add(key)
                    sums["mate", *key] += 1


def lines_and_contexts(docs: DataFrame, text: str, lang: str, source: str, words) -> DataFrame:
    """(kind, of, what, a, b, n, alone): lines by source and masked form, how many stand between blank lines; all records by source; forms and their mates by language and neighbours."""

    def make():
        model = words.value
        known, contexts = model.literal, _Contexts(model)

        def f(keys, texts):
            seen, alone = Counter(), Counter()
            for label, own, t in zip(*keys, texts, strict=True):
                contexts.add(t, label, seen)
                seen["record", own or "", "", None, None] += 1
                for line, by_itself in _alone(t):
                    m = mask(line, known)
                    if "@" in m and _WORD.search(m):
                        k = "line", own or "", m, None, None
                        seen[k] += 1
                        alone[k] += by_itself
            names = ("kind", "of", "what", "a", "b")
            return {n: [k[i] for k in seen] for i, n in enumerate(names)} | {"n": list(seen.values()), "alone": [alone[k] for k in seen]}

        return f

    rows = docs.where(F.col(text).isNotNull()).select(*(F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in (lang, source)), text)
    parts = map_texts(rows, [lang, source], text, "kind string, of string, what string, a string, b string, n bigint, alone bigint", make)
    return parts.groupBy("kind", "of", "what", "a", "b").agg(F.sum("n").alias("n"), F.sum("alone").alias("alone"))


def header_forms(sums: DataFrame) -> DataFrame:
    """(masked): forms of header lines in some source; other sources, however large, don't hide them."""
    lines = sums.where("kind = 'line'").select("of", F.col("what").alias("masked"), "n", "alone")
    records = sums.where("kind = 'record'").select("of", F.col("n").alias("records"))
    least = F.greatest(F.lit(HEADER_COUNT), F.col("records") * HEADER_SHARE)
    return lines.join(records, "of").where((F.col("n") >= least) & (F.col("alone") >= HEADER_ALONE * F.col("n"))).select("masked").distinct()


def unsupported(sums: DataFrame, words: Words) -> DataFrame:
    """(of, what): contested forms of a language that stand beside other neighbours than the word with their skeleton: they are no misreadings."""
    pairs = [(lang, w, m) for lang, by in words.contested.items() for w, m in by.items()]
    mates = sums.sparkSession.createDataFrame(pairs, "of string, what string, mate string")
    uses = sums.where("kind = 'form'").select("of", "what", "a", "b", "n").join(mates, ["of", "what"])
    sides = sums.where("kind = 'mate'").select("of", F.col("what").alias("mate"), "a", "b")
    left = sides.where("a IS NOT NULL").select("of", "mate", "a", F.lit(True).alias("before"))
    right = sides.where("b IS NOT NULL").select("of", "mate", "b", F.lit(True).alias("after"))
    held = uses.join(left, ["of", "mate", "a"], "left").join(right, ["of", "mate", "b"], "left")
    shared = F.sum(F.when(F.col("before") | F.col("after"), F.col("n")).otherwise(0))
    rows = held.groupBy("of", "what").agg(F.sum("n").alias("uses"), shared.alias("shared"))
    return rows.where((F.col("uses") >= USES) & (F.col("shared") < SUPPORTED * F.col("uses"))).select("of", "what")


def fit(docs: DataFrame, text: str = "markdown", lang: str = "lang", source: str = "source") -> Pages:
    """The frequent words of each language, which of their look-alikes are words of their own, and the masked forms of headers.

    Counted over all records in two passes, the second by what the first found. The driver gets words and forms with a
    minimal count; that of words doesn't grow with the corpus, that of headers is one of a source's own records, so that a
    record's verdicts don't change with other records.
    """
    spark = docs.sparkSession
    counts = cut_lineage(word_counts(docs, text, lang))
    by: dict[str, Counter] = defaultdict(Counter)
    for r in counts.where(F.col("n") >= MIN_COUNT).toLocalIterator():
        by[r.lang][r.word] = r.n
    words = Words(by)
    sums = cut_lineage(lines_and_contexts(docs, text, lang, source, spark.sparkContext.broadcast(words)))
    words.unsupported = {(r.of, r.what) for r in unsupported(sums, words).toLocalIterator()}
    return Pages(words, frozenset(r.masked for r in header_forms(sums).toLocalIterator()))


def noisy(docs: DataFrame, key: str, text: str, pages) -> DataFrame:
    """Keys of the records with at least one trace of page, line or misreading; ``pages`` is a broadcast ``Pages``.

    NULL, empty and blank texts have none; repeated rows give one row.
    """

    def make():
        model = pages.value

        def f(keys, texts):
            return {"k": [k for k, t in zip(keys[0], texts, strict=True) if k is not None and model.traces(t, first=True)]}

        return f

    return map_texts(docs, [key], text, "k bigint", make).withColumnRenamed("k", key).distinct()
