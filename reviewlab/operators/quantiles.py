"""Exact quantiles of a large column.

Spark's exact ``percentile`` keeps every distinct value in one task. Here a sketch narrows each
quantile to a small interval, one pass counts what lies below it, and only the values inside
reach the exact aggregate. The counts are exact, so the result does not depend on the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The exact aggregate gets at most this many values per quantile.
MAX_EXACT_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    max_exact_rows: int = MAX_EXACT_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> list[float | None]:
    """Quantiles with linear interpolation between the neighbouring ranks, nulls left out."""
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    low, high, total = values.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if total <= max_exact_rows:
        exact = values.agg(F.percentile("v", F.array(*[F.lit(p) for p in probabilities])))
        return exact.first()[0] or [None for _ in probabilities]
    return [
        _quantile(values, p, low, high, total, max_exact_rows, accuracy) for p in probabilities
    ]


def _quantile(
    values: DataFrame,
    p: float,
    low: float,
    high: float,
    total: int,
    max_exact_rows: int,
    accuracy: int,
) -> float:
    """One quantile, by narrowing ``[low, high]`` around the value of its rank.

    ``before`` rows lie below the interval and ``size`` rows in it, both counted exactly.
    """
    v = F.col("v")
    position = p * (total - 1)
    rank = math.floor(position)
    before, size = 0, total
    slack = 4.0 / accuracy
    while low < high and size > max_exact_rows:
        inside = values.where(v.between(low, high))
        share = (rank - before) / size
        around = [max(0.0, share - slack), min(1.0, share + slack)]
        left, right = inside.agg(F.percentile_approx("v", around, accuracy)).first()[0]
        below, upto = inside.agg(F.count_if(v < left), F.count_if(v <= right)).first()
        if rank - before < below:
            high, size = inside.where(v < left).agg(F.max("v")).first()[0], below
        elif rank - before >= upto:
            low = inside.where(v > right).agg(F.min("v")).first()[0]
            before, size = before + upto, size - upto
        elif (left, right) != (low, high):
            low, high = left, right
            before, size = before + below, upto - below
        else:
            # The two ends hold nearly all rows: settle on one, or go on strictly between them.
            at_low, at_high = inside.agg(F.count_if(v == low), F.count_if(v == high)).first()
            if rank - before < at_low:
                high, size = low, at_low
            elif rank - before >= size - at_high:
                low, before, size = high, before + size - at_high, at_high
            else:
                between = inside.where((v > low) & (v < high))
                low, high = between.agg(F.min("v"), F.max("v")).first()
                before, size = before + at_low, size - at_low - at_high

    if low == high:
        found = [low] * min(2, before + size - rank)
    else:
        ordered = values.where(v.between(low, high)).orderBy("v")
        found = [row["v"] for row in ordered.offset(rank - before).limit(2).collect()]
    if position == rank:
        return found[0]
    if len(found) == 1:
        found.append(values.where(v > high).agg(F.min("v")).first()[0])
    return found[0] + (found[1] - found[0]) * (position - rank)
