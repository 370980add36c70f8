"""Business measures as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# ---- fixed values: weights of the engagement score ----
REVIEW_WEIGHT = 1.0
TIP_WEIGHT = 0.5
PHOTO_WEIGHT = 0.25
CHECKIN_WEIGHT = 0.2

# ---- fixed values: review-count groups in display order, and their bounds ----
REVIEW_GROUPS = ["0 reviews", "1-5 reviews", "6-20 reviews", "21-50 reviews", "51+ reviews"]
REVIEW_BOUNDS = [(1, 5), (6, 20), (21, 50)]


def engagement_score(reviews: str, tips: str, photos: str, checkins: str) -> Column:
    return (
        F.col(reviews) * REVIEW_WEIGHT
        + F.col(tips) * TIP_WEIGHT
        + F.col(photos) * PHOTO_WEIGHT
        + F.col(checkins) * CHECKIN_WEIGHT
    )


def growth_rate(current: Column, previous: Column) -> Column:
    """Relative change; null without a previous value or when it is zero."""
    return F.when(previous != 0, (current - previous) / previous)


#: Doubles are summed as decimals of twelve places: such sums are exact, so they do not depend on the order of the rows.
EXACT = "decimal(38,12)"


def exact(value: str | Column) -> Column:
    """A double as an exact summand; null for what is no number."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(EXACT)


def mean(total: str | Column, n: str | Column) -> Column:
    """Average from a sum and a count; null when nothing was counted."""
    n = F.col(n) if isinstance(n, str) else n
    total = F.col(total) if isinstance(total, str) else total
    return F.when(n > 0, total.cast("double") / n)


def exact_mean(value: str | Column) -> Column:
    """Average of a double column, the same for any order and partitioning of the rows."""
    return mean(F.sum(exact(value)), F.count(exact(value)))


def null_safe_sum(columns: list[str]) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def review_group(review_count: str) -> Column:
    """Label of the review-count group. Zero and negative counts share the first one."""
    n = F.col(review_count)
    zero, *between, most = REVIEW_GROUPS
    label = F.when(n > REVIEW_BOUNDS[-1][1], most)
    for group, (low, high) in zip(between, REVIEW_BOUNDS):
        label = label.when(n.between(low, high), group)
    return label.otherwise(zero)


def review_group_rank(label: str) -> Column:
    return F.array_position(F.array(*[F.lit(g) for g in REVIEW_GROUPS]), F.col(label))
