"""Review state: the append-only log of bad cases and the labels merged into a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.schema import REVIEW_STAGES

#: What orders records of one key, after their time as text: ties go to the greatest of these.
TIES = ("stage", "note", "flagged_by", "is_bad")


def latest_flags(log: DataFrame, line_no: str | None = None, by_time: bool = False) -> DataFrame:
    """The last record of each sha256, tombstones too.

    Later means a greater ``flagged_at`` as text, as the log is written (or as an instant, with ``by_time``); a missing one
    is the earliest. Ties go to the later line if the log has line numbers, else to the greatest of ``TIES``.
    Records without sha256 are skipped.
    """
    at = F.coalesce(F.try_to_timestamp("flagged_at").cast("double"), F.lit(-1e18)) if by_time else F.coalesce("flagged_at", F.lit(""))
    ties = [F.col(line_no)] if line_no else [F.coalesce(F.col(t).cast("string"), F.lit("")) for t in TIES]
    order = F.struct(at, *ties)
    row = F.struct(*(c for c in log.columns if c != "sha256"))
    best = log.where("sha256 IS NOT NULL AND sha256 <> ''").groupBy("sha256").agg(F.max_by(row, order).alias("r"))
    return best.select("sha256", "r.*")


def active_flags(log: DataFrame, line_no: str | None = None) -> DataFrame:
    return latest_flags(log, line_no).where(F.coalesce("is_bad", F.lit(False)))


def valid_flag(sha: Column, stage: Column, note: Column) -> tuple[Column, Column, Column]:
    """(acceptable, stage with its default, note as kept) of a record to append."""
    known = stage.isNull() | stage.isin(*REVIEW_STAGES)
    return F.coalesce((sha != "") & known, F.lit(False)), F.coalesce(stage, F.lit("overall")), F.substring(F.coalesce(note, F.lit("")), 1, 1000)


def parsed_log(lines: DataFrame, schema: str) -> DataFrame:
    """Records of a log of JSON lines (column ``value``): blank lines, malformed ones and those without sha256 are skipped."""
    rows = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return rows.where("r._bad IS NULL AND r.sha256 IS NOT NULL AND r.sha256 <> ''").select("r.*").drop("_bad")


def merged_labels(base: DataFrame, updates: DataFrame, key: str, columns: list[str], position: str, now: Column) -> DataFrame:
    """``base`` updated by matching ``updates``; keys it lacks are ignored.

    An update has a map ``set`` of column names to values as text. The last update of a key with a non-NULL label counts. A
    column named in the map takes its value, be it NULL; one that isn't named stays. ``annotated_at`` becomes ``now``.
    """
    good = updates.where(F.col(key).isNotNull() & (F.col(key) != "") & F.try_element_at("set", F.lit("label")).isNotNull())
    last = good.groupBy(key).agg(F.max_by("set", position).alias("set"))
    joined = base.join(last, key, "left")
    hit = F.col("set").isNotNull()
    kinds = dict(base.dtypes)

    def value(c: str) -> Column:
        if c == "annotated_at":
            return F.when(hit, now).otherwise(F.col(c)).alias(c)
        if c not in columns:
            return F.col(c)
        return F.when(hit & F.map_contains_key("set", c), F.try_element_at("set", F.lit(c)).cast(kinds[c])).otherwise(F.col(c)).alias(c)

    return joined.select(*(value(c) for c in base.columns))


def exported_labels(base: DataFrame) -> DataFrame:
    """One row: the number of labelled records and they as a JSON array in order of id."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("id", "label"))), lambda r: r)
    return base.where("label IS NOT NULL").agg(F.count("*").alias("total"), F.to_json(rows).alias("annotations"))


def flag(sha256: str, *, is_bad: bool = True, stage: str | None = None, tags: list[str] | None = None, note: str | None = None, at: str, by: str = "") -> dict:
    """A record to append to the log of bad cases; raises ValueError for what the log doesn't take."""
    if not isinstance(sha256, str) or not sha256:
        raise ValueError("sha256 must be a text that isn't empty")
    if stage is not None and stage not in REVIEW_STAGES:
        raise ValueError(f"unknown stage {stage!r}; there are {', '.join(REVIEW_STAGES)}")
    if not all(isinstance(t, str) for t in tags or []):
        raise ValueError("tags must be texts")
    return {"sha256": sha256, "is_bad": is_bad, "stage": stage or "overall", "tags": list(tags or []), "note": (note or "")[:1000], "flagged_at": at, "flagged_by": by}


def unflag(sha256: str, *, at: str, by: str = "") -> dict:
    """The record that withdraws a flag; the log keeps what was before."""
    return flag(sha256, is_bad=False, at=at, by=by)
