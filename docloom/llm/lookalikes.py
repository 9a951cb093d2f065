"""One form for text that looks the same (problem 3)."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.batches import map_texts
from docloom.session import cut_lineage

#: Letters of other scripts and the Latin letters that they look like.
LOOKALIKES = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝӏҮүҺԌ", "ABESIJKMHOPCTYXaesijopcyxhdqwlYyhG"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαινορυϲϳ", "ABEZHIKMNOPTYXCaivopucj"),
    "Latin": ("ɑɡɩƖ", "agiI"),
    "Armenian": ("օսհոՕՍ", "ouhnOU"),
    "Cherokee": ("ᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏞᏟᏢᏙᏦ", "AJEWMHGZRWLCPVK"),
    "Lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    "Coptic": ("ⲎⲒⲔⲘⲚⲞⲟⲢⲣⲤⲥⲦⲬ", "HIKMNOoPpCcTX"),
}
#: Marks without ink beside the characters of category Cf.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠎⠀ㅤﾠ﻿­"
#: Forms whose compatibility reading is the same sign in another width or joined with its neighbour.
SAME_FORMS = ("<wide>", "<narrow>", "<font>")
LIGATURES, NUMERALS = range(0xFB00, 0xFB50), range(0x2160, 0x2180)
#: Format characters with ink, which stand before digits or words and stay.
INKED = "\u0600\u0601\u0602\u0603\u0604\u0605\u06dd\u070f\u0890\u0891\u08e2\U000110bd\U000110cd"
#: Characters that compose with the one before them, beside the combining marks: half-width sound marks.
SOUND = {"\uff9e": "\u3099", "\uff9f": "\u309a"}


class ConflictError(ValueError):
    """Two rules send one character to different forms, or the form of one rule is changed by another."""


def _rules() -> dict[str, str]:
    rules: dict[str, str] = {}

    def add(c: str, form: str) -> None:
        if rules.setdefault(c, form) != form:
            raise ConflictError(f"U+{ord(c):04X}: {rules[c]!r} and {form!r}")

    letters: dict[str, str] = {}
    for olds, news in LOOKALIKES.values():
        for c, form in zip(olds, news, strict=True):
            if letters.setdefault(c, form) != form:
                raise ConflictError(f"U+{ord(c):04X}: {letters[c]!r} and {form!r}")
    for point in range(0x80, sys.maxunicode + 1):
        c = chr(point)
        category = unicodedata.category(c)
        if category in ("Cn", "Cs", "Co") or c in INKED:
            continue
        if category == "Cf" or c in INVISIBLE or 0xFE00 <= point <= 0xFE0F or 0xE0100 <= point <= 0xE01EF:
            add(c, "")
        elif category == "Zs":
            add(c, " ")
        elif c in letters:
            add(c, letters[c])
        elif unicodedata.decomposition(c).startswith(SAME_FORMS) or (point in LIGATURES or point in NUMERALS) and unicodedata.decomposition(c).startswith("<compat>"):
            add(c, SOUND.get(c) or unicodedata.normalize("NFKC", c))
        else:  # a precomposed letter follows its base; marks go back on afterwards
            apart = unicodedata.normalize("NFD", c)
            if apart != c and not 0xAC00 <= point < 0xD7A4:
                add(c, unicodedata.normalize("NFC", "".join(letters.get(x, x) for x in apart)))
    return rules


class Transducer:
    """The rules compiled: at each place the longest cluster that has a rule, base with its marks and what is invisible between them, gives its one form.

    ``single`` maps characters, closed under itself. Clusters of several characters have the form of their composition,
    worked out once each. Raises ``ConflictError`` if the rules disagree, so a changed table can't silently depend on the
    order of rules.
    """

    def __init__(self):
        rules = _rules()
        for c in list(rules):  # a form may hold further characters with a rule, as a wide letter's accent; one level closes
            rules[c] = "".join(rules.get(x, x) for x in rules[c])
        for c, form in rules.items():
            if any(rules.get(x, x) != x for x in form):
                raise ConflictError(f"U+{ord(c):04X}: {form!r} isn't final")
        self.single = {ord(c): form for c, form in rules.items()}
        joining = [*(chr(k) for a, b in MARKS for k in range(a, b + 1)), *SOUND]
        silent = [c for c, form in rules.items() if form == "" and c not in joining]
        changed = [c for c, form in rules.items() if form != c and form != "" and c not in joining]
        joins, none, change = _charset(joining), _charset(silent), _charset(changed)
        # a cluster has a mark; else a run of characters that each have a form of their own, without the base of a cluster
        self.pattern = re.compile(f"[^{joins}{none}][{none}]*[{joins}][{joins}{none}]*|[{change}{none}]+(?![{none}]*[{joins}])|[{change}{none}]|[{joins}]+")
        # a text without marks has no clusters: the same transducer without those that begin with any character
        self.marks, self.runs = re.compile(f"[{joins}]"), re.compile(f"[{change}{none}]+")
        self.clusters: dict[str, str] = {}

    def _form(self, m: re.Match) -> str:
        found = m[0]
        form = self.clusters.get(found)
        if form is None:
            form = unicodedata.normalize("NFC", found.translate(self.single))
            if len(found) <= 8:
                if len(self.clusters) > 100_000:
                    self.clusters.clear()
                self.clusters[found] = form
        return form

    def __call__(self, text: str) -> str:
        return (self.pattern if self.marks.search(text) else self.runs).sub(self._form, text)


#: Ranges of combining marks that compose with a base or stand on it.
MARKS = ((0x300, 0x34E), (0x350, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0x3099, 0x309A), (0xFE20, 0xFE2F))


def _charset(characters: list[str]) -> str:
    """The inside of a pattern's set of characters, as ranges."""
    spans: list[list[int]] = []
    for k in sorted(map(ord, characters)):
        if spans and k == spans[-1][1] + 1:
            spans[-1][1] = k
        else:
            spans.append([k, k])
    return "".join(re.escape(chr(a)) + "-" + re.escape(chr(b)) for a, b in spans)


@lru_cache(maxsize=1)
def compiled() -> Transducer:
    return Transducer()


def one_form(text: str) -> str:
    """The text in its one form: one pass from left to right replaces the longest cluster with a rule at each place.

    Widths, ligatures, invisible characters, kinds of space, composition and look-alike letters are unified; case,
    accents, digits, raised digits, punctuation and all other letters stay. ``one_form(one_form(t)) == one_form(t)``.
    """
    return text if text.isascii() else compiled()(text)


_ALIKE = "".join(olds for olds, _ in LOOKALIKES.values())
_MEETS = re.compile("[A-Za-z][Ͱ-ԯ]|[Ͱ-ԯ][A-Za-z]")
_MIXED = re.compile("[^\\W\\d_]*(?:[A-Za-z][Ͱ-ԯ]|[Ͱ-ԯ][A-Za-z])[^\\W\\d_]*")
_ALONE = re.compile(f"(?<![^\\W_])[{_ALIKE}]+(?![^\\W_])")
_BACK = {k: {ord(new): old for old, new in zip(*LOOKALIKES[k], strict=True)} for k in ("Cyrillic", "Greek")}
_FOREIGN = re.compile(f"(?![{_ALIKE}])[Ͱ-ԯ]")


@lru_cache(maxsize=1)
def _plain() -> tuple[dict[int, str], re.Pattern]:
    """The transducer without the look-alikes' rules, and a pattern that finds whether it has anything to do."""
    alike = set(_ALIKE)
    rules = {k: v for k, v in compiled().single.items() if v != chr(k) and unicodedata.normalize("NFD", chr(k))[0] not in alike}
    return rules, re.compile("[" + _charset([chr(k) for k in {*rules, *range(0x300, 0x370)}]) + "]")


def _own_script(m: re.Match) -> str:
    """A word of letters of two scripts in the one that has all of them, as seen; as it is if neither has."""
    word = m[0]
    foreign = _FOREIGN.search(word)
    if not foreign:
        return word.translate(compiled().single)
    back = _BACK["Cyrillic" if foreign[0] >= "Ѐ" else "Greek"]
    return word.translate(back) if all(ord(c) in back for c in word if c.isascii()) else word


def readable(text: str) -> str:
    """As ``one_form``, but look-alike letters change only within words of two scripts, or where no word is of their script.

    For texts that people or models read on; ``one_form`` is the form to compare by.
    """
    if text.isascii():
        return text
    rules, odd = _plain()
    if odd.search(text):
        text = unicodedata.normalize("NFC", text.translate(rules))
    if _MEETS.search(text):
        text = _MIXED.sub(_own_script, text)
    if _ALONE.search(text) and len(_FOREIGN.findall(text)) < 5:
        text = _ALONE.sub(lambda m: m[0].translate(compiled().single), text)
    return text


def forms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per distinct record with ink: ``key``, raw (64-bit hash of the text) and form_hi, form_lo (128-bit hash of its one form).

    NULL, empty and blank texts, also those blank only in their one form, give no row. Only hashes leave the workers.
    """

    def make():
        signed = lambda x: x - (1 << 64) if x >> 63 else x

        def f(keys, texts):
            out = {"k": [], "raw": [], "form_hi": [], "form_lo": []}
            for k, t in zip(keys[0], texts, strict=True):
                form = one_form(t)
                if k is None or not form.strip():
                    continue
                h = xxhash.xxh3_128_intdigest(form.encode("utf-8", "surrogatepass"))
                out["k"].append(k)
                out["raw"].append(signed(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))))
                out["form_hi"].append(signed(h >> 64))
                out["form_lo"].append(signed(h & (1 << 64) - 1))
            return out

        return f

    return map_texts(docs, [key], text, "k bigint, raw bigint, form_hi bigint, form_lo bigint", make).withColumnRenamed("k", key).distinct()


def normalized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per distinct record: ``key`` and one_form, the text in its one form; NULL texts give ''; records without a key give no row."""

    def make():
        def f(keys, texts):
            at = [i for i, k in enumerate(keys[0]) if k is not None]
            return {"k": [keys[0][i] for i in at], "one_form": [one_form(texts[i]) for i in at]}

        return f

    return map_texts(docs, [key], text, "k bigint, one_form string", make).withColumnRenamed("k", key).dropDuplicates([key])


def same_looking_classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Records whose texts look like another's of other characters: ``key``, class_id (the least key of its class) and n_texts, the different raw texts in the class.

    The form for classes too large to pair: one row a record, partial aggregates by the hash of the one form only.
    """
    found = cut_lineage(forms(docs, key, text))
    by = ["form_hi", "form_lo"]
    raws = found.groupBy(*by, "raw").agg(F.min(key).alias("least"))
    classes = raws.groupBy(*by).agg(F.count("*").alias("n_texts"), F.min("least").alias("class_id")).where("n_texts > 1")
    return found.join(classes, by).select(key, "class_id", "n_texts").distinct()


def same_looking_pairs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Pairs id_a < id_b of records whose texts look the same but are not the same characters.

    Records group by the hash of their one form. Groups with a single raw text, however many copies it has, drop out
    first. In the rest different raw texts are paired, once each whatever their copies, and then their records: copies of
    one raw text never meet. Keys are hashes, and a skewed group is split by adaptive execution.
    """
    found = cut_lineage(forms(docs, key, text))
    by = ["form_hi", "form_lo"]
    varied = found.groupBy(*by).agg((F.min("raw") != F.max("raw")).alias("varied")).where("varied").select(*by)
    left = found.join(varied, by)
    raws = left.select(*by, "raw").distinct()
    a, b = raws.withColumnRenamed("raw", "raw_a"), raws.withColumnRenamed("raw", "raw_b")
    differ = a.join(b, by).where("raw_a < raw_b")
    x, y = left.select(*by, F.col("raw").alias("raw_a"), F.col(key).alias("x")), left.select(*by, F.col("raw").alias("raw_b"), F.col(key).alias("y"))
    pairs = differ.join(x, [*by, "raw_a"]).join(y, [*by, "raw_b"])
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
