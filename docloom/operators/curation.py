"""Filters and keys of the reference's curation stages; their parameters are stated where they are given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text

#: Least characters by language; other languages have no limit.
LEAST_CHARS = {"zh": 200, "en": 500}
#: Other names of these languages in labels, whose case and region don't matter.
NAMES = {"zh": ("zho", "chi", "chinese"), "en": ("eng", "english")}
#: Personal data by kind, in the order in which they are replaced.
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ipv4": r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b",
    "cn_id": r"\b[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx]\b",
    "phone": r"\b1[3-9]\d{9}\b",
    "uscc": r"\b[0-9A-HJ-NPQRTUWXY]{2}\d{6}[0-9A-HJ-NPQRTUWXY]{10}\b",
    "passport": r"\b[EG]\d{8}\b",
    "card": r"\b\d{16,19}\b",
    "ipv6": r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b",
    "plate": r"[京津沪渝冀豫云辽黑湘皖鲁新苏浙赣鄂桂甘晋蒙陕吉闽贵粤青藏川宁琼][A-Z][A-Z0-9]{5,6}\b",
}


#: Texts without any of this hold no personal data: a sign of mail or address, eight digits and letters in a row, a plate's region.
MAY_HOLD = r"@|[0-9A-Z]{8}|\d\.\d|[0-9A-Fa-f]:[0-9A-Fa-f]|\d{8}|[京津沪渝冀豫云辽黑湘皖鲁新苏浙赣鄂桂甘晋蒙陕吉闽贵粤青藏川宁琼][A-Z]"


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    d = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda x: x != "")), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(F.when(x.cast("int") > 4, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def redacted(c: Column) -> Column:
    """Text with personal data replaced by marks of their kind; a text that can hold none passes at one look."""
    done = c
    for kind, pattern in PII.items():
        mark = f"⟨PII:{kind}⟩"
        if kind == "card":  # only numbers with a valid check digit
            numbers = F.filter(F.array_distinct(F.regexp_extract_all(done, F.lit(pattern), F.lit(0))), luhn)
            done = F.aggregate(numbers, done, lambda a, n: F.replace(a, n, F.lit("⟨PII:card⟩")))
        else:
            done = F.regexp_replace(done, pattern, mark)
    return F.when(c.rlike(MAY_HOLD), done).otherwise(c)


def pii_audit(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(``key``, kind, sha, n): the hash of each piece of personal data that a document holds, and how often, for an audit table."""

    def hits(kind: str, pattern: str) -> Column:
        found = F.regexp_extract_all(column, F.lit(pattern), F.lit(0))
        return F.filter(found, luhn) if kind == "card" else found

    parts = F.array(*(F.struct(F.lit(kind).alias("kind"), hits(kind, pattern).alias("hits")) for kind, pattern in PII.items()))
    rows = docs.where(F.col(column).rlike(MAY_HOLD)).select(key, F.inline(parts)).where(F.size("hits") > 0)
    return rows.select(key, "kind", F.explode("hits").alias("hit")).groupBy(key, "kind", F.sha2("hit", 256).alias("sha")).agg(F.count("*").alias("n"))


def repeated_ngrams(c: Column, n: int = 5) -> Column:
    """Share of a text's n-grams of words that repeat another one; 0 for texts with fewer than two."""
    words = F.filter(F.split(F.lower(c), f"[{text.SPACE}]+"), lambda w: w != "")

    def grams(w: Column) -> Column:
        m = F.greatest(F.lit(0), F.size(w) - (n - 1))
        g = F.slice(w, 1, m)
        for j in range(1, n):
            g = F.zip_with(g, F.slice(w, j + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
        return g

    # a lambda's variable is evaluated once, a repeated expression need not be
    made = F.transform(F.array(words), grams)
    return F.element_at(F.transform(made, lambda g: text.safe_ratio(F.size(g) - F.size(F.array_distinct(g)), F.size(g))), 1)


def symbol_ratio(c: Column) -> Column:
    """Share of characters beyond ASCII that are no letters or digits of any script."""
    return text.safe_ratio(F.length(F.regexp_replace(c, r"[\x{00}-\x{7F}]|\p{L}|\p{N}", "")), F.length(c))


def line_stats(c: Column) -> tuple[Column, Column, Column]:
    """(lines, mean length, variance of lengths) of a text's lines."""
    sizes = F.transform(F.split(c, "\n"), lambda x: F.length(x).cast("bigint"))
    n = F.size(sizes)
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    squares = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    mean = total / n
    return n.cast("bigint"), mean, squares / n - mean * mean


def link_share(c: Column) -> Column:
    """Share of characters in URLs and e-mail addresses."""
    found = F.regexp_extract_all(c, F.lit(r"https?://[^ \n\t]+|" + PII["email"]), F.lit(0))
    return text.safe_ratio(F.aggregate(found, F.lit(0), lambda a, x: a + F.length(x)), F.length(c))


def digit_share(c: Column) -> Column:
    return text.safe_ratio(F.length(F.regexp_replace(c, "[^0-9]", "")), F.length(c))


def long_enough(lang: Column, chars: Column) -> Column:
    """Whether a text has its language's least number of characters."""
    least = F.lit(0)
    named = F.split(F.lower(F.trim(lang)), "[-_]")[0]
    for code, n in LEAST_CHARS.items():
        least = F.when(named.isin(code, *NAMES[code]), n).otherwise(least)
    return F.coalesce(chars >= least, F.lit(False))


def first_of_same(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(content_md5, ``key``, copies): of documents with the same normalized text the least key, and their number.

    Grouping is by hash with partial sums, so copies of one text by the million meet as one row a task; NULL texts are no copies of one another and give no row.
    """
    digest = F.md5(text.normalize_text(F.col(column)))
    return docs.where(F.col(column).isNotNull()).groupBy(digest.alias("content_md5")).agg(F.min(key).alias(key), F.count_distinct(key).alias("copies"))


def hash_sample(docs: DataFrame, key: str, one_in: int = 1000) -> DataFrame:
    """The same sample on every run: rows whose key's digest falls in one of ``one_in`` classes."""
    return docs.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % one_in == 0)


def quality_bucket(score: Column) -> Column:
    """low, mid or high; none where there is no score."""
    known = F.when(~F.isnan(score), score)
    return F.when(known.isNull(), "none").when(known < 1.0, "low").when(known < 2.0, "mid").otherwise("high")


def to_do(inputs: DataFrame, manifest: DataFrame, stage: str) -> DataFrame:
    """Shards of ``inputs`` that the manifest (shard, stage, status) doesn't list as done for a stage."""
    done = manifest.where((F.col("stage") == stage) & (F.col("status") == "done")).select("shard").distinct()
    return inputs.join(done, "shard", "left_anti")
