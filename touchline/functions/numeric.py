"""Column expressions on numbers: outcomes, rates, bands."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def if_else(test: Column, yes, no) -> Column:
    """Like ``when/otherwise`` but a missing test gives missing."""
    return F.when(test.isNull(), None).when(test, yes).otherwise(no)


def total(value) -> Column:
    """Sum that is 0 for nothing."""
    return F.coalesce(F.sum(_c(value)), F.lit(0))


def share_true(test: Column) -> Column:
    """Mean of a predicate, missing rows left out."""
    return F.avg(test.cast("double"))


def ratio(top, bottom, scale: float = 1.0) -> Column:
    """``scale * top / bottom``; missing for a zero bottom."""
    return F.try_divide(_c(top) * F.lit(float(scale)), _c(bottom))


def outcome(own, other, win=1.0, tie=0.5, loss=0.0, unplayed=None) -> Column:
    """Points of a result from the own side; ``unplayed`` when a score is missing."""
    own, other = _c(own), _c(other)
    played = F.when(own > other, F.lit(win)).when(own == other, F.lit(tie)).when(own < other, F.lit(loss))
    return played.otherwise(F.lit(unplayed).cast("double"))


def winner(home, away, home_score, away_score) -> Column:
    home_score, away_score = _c(home_score), _c(away_score)
    return (
        F.when(home_score > away_score, _c(home))
        .when(home_score < away_score, _c(away))
        .when(home_score == away_score, F.lit("tie"))
    )


def bands(value, limits: Sequence[tuple[float, float, str]]) -> Column:
    """First band ``(low, high, label)`` with ``low <= value <= high``; else missing."""
    value = _c(value)
    chain = None
    for low, high, label in limits:
        inside = value.between(low, high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


# Age bands of the indoor rowing table (0 itself is outside the first).
ROWING_AGE_BANDS = [
    (1, 12, "0-12"), (13, 18, "13-18"), (19, 29, "19-29"),
    (30, 39, "30-39"), (40, 49, "40-49"), (50, 54, "50-54"),
    (55, 59, "55-59"), (60, 64, "60-64"), (65, 69, "65-69"),
]

# Size bands of a difference in world ranking.
RANK_DIFFERENCE_BANDS = [(0, 30, "Low"), (31, 75, "Medium"), (76, float("inf"), "High")]

# Points per medal.
MEDAL_POINTS = {"Gold": 3, "Silver": 2, "Bronze": 1}

# Statistics that rise when an umpire helps the batting side, or the other.
HELPS_BATTING = ("BB", "R", "BA", "OBP", "SLG")
HELPS_PITCHING = ("K",)


def umpire_rating(stat, percent) -> Column:
    """Which side an umpire favours, from a statistic's change in percent."""
    stat, percent = _c(stat), _c(percent)
    toward = F.when(stat.isin(*HELPS_BATTING), percent).when(stat.isin(*HELPS_PITCHING), -percent)
    return (
        F.when(percent == 0, "Neither").when(toward > 0, "Offensive").when(toward < 0, "Defensive")
    )


def weighted(category, weights: Mapping[str, float]) -> Column:
    """Points of a category; categories without a weight count 0."""
    chain = F.lit(0)
    for label, points in weights.items():
        chain = F.when(_c(category) == label, F.lit(points)).otherwise(chain)
    return chain


def trimmed_sum(values: Sequence[str], drop_each_side: int) -> Column:
    """Sum of the middle values: the highest and lowest ones are dropped."""
    kept = len(values) - 2 * drop_each_side
    middle = F.slice(F.array_sort(F.array(*[_c(v) for v in values])), drop_each_side + 1, kept)
    return F.aggregate(middle, F.lit(0.0), lambda total_, v: total_ + v.cast("double"))


def percent_change(multiplier) -> Column:
    """``1.05`` to ``5`` percent."""
    return (_c(multiplier) - 1) * 100
