"""Score cutoffs that keep a target percentage of each group's records (problem 7)."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import cut_lineage

#: Cuts laid into each group's bracket per pass over the data, beside the one where its tangents meet and those at its ends.
CUTS = 16


def _scored(results: DataFrame) -> DataFrame:
    s = F.col("quality_score")
    return results.select("result_id", "source", "extract_backend", "quality_score").where(s.isNotNull() & ~F.isnan(s)).distinct()


def pinball_loss(cut: float, n: int, total: float, above_n: int, above: float, keep: int) -> tuple[float, int]:
    """Pinball loss of ``cut`` for a percentage to keep, and its subgradient just below the cut, exact.

    From ``n`` scores that sum up to ``total``, of which ``above_n`` with the sum ``above`` lie at or above the cut.
    """
    loss = (100 - keep) * (above - above_n * cut) + keep * ((n - above_n) * cut - (total - above))
    return loss, keep * (n - above_n) - (100 - keep) * above_n


@dataclass
class Bracket:
    """A group's search: the least and greatest score that may be its cutoff, with how many scores of what sum lie at or above each, and above both."""

    keep: int
    n: int
    total: float
    lo: float
    hi: float
    at_lo: tuple[int, float]
    at_hi: tuple[int, float]
    beyond: tuple[int, float] = (0, 0.0)

    def loss(self, cut: float, at: tuple[int, float]) -> tuple[float, int]:
        return pinball_loss(cut, self.n, self.total, *at, self.keep)

    def cuts(self) -> list[float]:
        """Where the loss is asked for next: from both ends ever closer to where the tangents meet, and each end by itself."""
        lo, hi = self.lo, self.hi
        if math.isinf(lo) or math.isinf(hi):
            return [-sys.float_info.max, 0.0, math.inf]
        middle = lo / 2 + hi / 2
        (f, g), (e, h) = self.loss(lo, self.at_lo), self.loss(hi, self.at_hi)
        if h > g:  # the convex loss lies above both tangents, so that its least value is near where these meet
            met = (f - e + h * hi - g * lo) / (h - g)
            middle = met if lo < met < hi else middle
        inner = [x + (middle - x) * (1 - 0.5**j) for x in (lo, hi) for j in range(1, CUTS // 2 + 1)]
        return sorted({math.nextafter(lo, math.inf), hi, middle, *(x for x in inner if lo < x <= hi and math.isfinite(x))})

    def narrow(self, slots: list[tuple[int, int, float, float, float]]) -> None:
        """Keep the interval between cuts in which the subgradient changes sign: its own scores, that is, the neighbours of its cuts.

        ``slots`` has (number, count, sum, least, greatest score) of the scores between cuts.
        """
        above, held = self.beyond
        for _, n, s, lo, hi in sorted(slots, reverse=True):
            if self.loss(lo, (above + n, held + s))[1] <= 0:
                self.lo, self.hi, self.at_lo, self.at_hi, self.beyond = lo, hi, (above + n, held + s), (above + 1, held + hi), (above, held)
                return
            above, held = above + n, held + s


def search(results: DataFrame, targets: DataFrame) -> tuple[DataFrame, dict[tuple[str, str], Bracket]]:
    """Counts by group and score, cut off from their lineage, and each group's finished bracket.

    The cutoff is the greatest minimiser of the group's convex pinball loss among its scores. A cutting-plane search finds
    it: each pass lays cuts into every group's bracket, closer and closer to where the tangents of its ends meet, and
    aggregates counts and sums between them, from which the losses and subgradients at all cuts follow. The bracket
    becomes the interval in which the subgradient changes sign, snapped to its outermost scores; one score is the end.
    Only the group states, one per row of ``targets``, reach the driver.
    """
    spark = results.sparkSession
    keys = ["source", "extract_backend"]
    wanted = targets.where("keep_percent IS NOT NULL AND source IS NOT NULL AND extract_backend IS NOT NULL").groupBy(*keys).agg(F.greatest(F.lit(0), F.least(F.lit(100), F.max("keep_percent"))).alias("keep_percent"))
    counts = cut_lineage(_scored(results).join(wanted, keys).groupBy(*keys, "keep_percent", F.col("quality_score").alias("score")).agg(F.count("*").alias("n")))
    state: dict = {}
    for r in counts.groupBy(*keys, "keep_percent").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("score")).alias("s"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect():
        state[r.source, r.extract_backend] = Bracket(r.keep_percent, r.n, r.s, r.lo, r.hi, (r.n, r.s), (1, r.hi))
    while left := [(s, b, v.lo, v.hi, v.cuts()) for (s, b), v in state.items() if v.lo < v.hi]:
        asked = spark.createDataFrame(left, "source string, extract_backend string, lo double, hi double, cuts array<double>")
        inside = counts.join(asked, keys).where("score BETWEEN lo AND hi")
        slot = F.size(F.filter("cuts", lambda x: x <= F.col("score")))
        passed: dict = {}
        for r in inside.groupBy(*keys, slot.alias("slot")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("score")).alias("s"), F.min("score").alias("lo"), F.max("score").alias("hi")).collect():
            passed.setdefault((r.source, r.extract_backend), []).append((r.slot, r.n, r.s, r.lo, r.hi))
        for key, slots in passed.items():
            state[key].narrow(slots)
    return counts, state


def cutoffs(results: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target group with scored records: source, extract_backend, keep_percent, n_scored, cutoff, n_kept.

    The cutoff is the highest score at or above which at least ``keep_percent`` percent of the group's distinct
    ``result_id`` lie (see ``search``).

    NULL and NaN scores, NULL group keys and groups without a target take no part; repeated rows count once; a group's
    ties are kept or dropped together; of several targets for a group the greatest percentage holds. Targets outside
    0 to 100 are clamped; 0 keeps the ties of the top score.
    """
    counts, state = search(results, targets)
    keys = ["source", "extract_backend"]
    found = results.sparkSession.createDataFrame([(s, b, v.keep, v.n, v.lo) for (s, b), v in state.items()], "source string, extract_backend string, keep_percent int, n_scored bigint, cutoff double")
    kept = counts.join(found.select(*keys, "cutoff"), keys).where("score >= cutoff").groupBy(*keys).agg(F.sum("n").alias("n_kept"))
    return found.join(kept, keys)


def optimality(results: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target group: source, extract_backend, cutoff, loss (rounded), and the subgradients of the loss below and above the cutoff.

    In percent units, so that the subgradients are whole numbers: that below is at most 0, that above greater than 0.
    Rows as of ``cutoffs``; the loss of a group with an infinite score is NULL.
    """
    _, state = search(results, targets)
    rows = []
    for (s, b), v in state.items():
        loss, below = v.loss(v.lo, v.at_lo)
        rows.append((s, b, v.lo, round(loss, 4) if math.isfinite(loss) else None, below, v.keep * (v.n - v.beyond[0]) - (100 - v.keep) * v.beyond[0]))
    return results.sparkSession.createDataFrame(rows, "source string, extract_backend string, cutoff double, loss double, slope_below bigint, slope_above bigint")


def kept_results(results: DataFrame, targets: DataFrame) -> DataFrame:
    """The distinct ``result_id`` of scored records at or above their group's cutoff (see ``cutoffs``)."""
    cut = cutoffs(results, targets).select("source", "extract_backend", "cutoff")
    return _scored(results).join(cut, ["source", "extract_backend"]).where("quality_score >= cutoff").select("result_id").distinct()
