"""Exact quantiles of a column in every group at once.

A mergeable sketch per group narrows each quantile to an interval. One pass counts what lies below
the interval and each distinct value inside it, for all groups together, and the value of the
wanted rank is read off the running counts. Quantiles whose rank lies outside their interval, which
the sketch makes unlikely, are counted again over the whole group, so the result is always exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.session import materialize

#: Size of a sketch; its ranks are off by less than a thousandth in 99 of 100 cases.
SKETCH_K = 4096
#: Share of the group's rows by which an interval reaches beyond the wanted rank on either side.
SLACK = 0.002


def group_sketches(df: DataFrame, group: str, column: str) -> DataFrame:
    """``group, n, sketch``: values and a quantile sketch of them for each group.

    Nulls and NaN are left out; rows without a group are a group of their own. Sketches are built
    before the shuffle, so a group that holds most rows travels as one sketch per task.
    """
    value = F.col(column).cast("double")
    values = df.select(F.col(group).alias("group"), value.alias("v"))
    return (
        values.where(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("group")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"kll_sketch_agg_double(v, {SKETCH_K})").alias("sketch"),
        )
    )


def merge_sketches(*stored: DataFrame) -> DataFrame:
    """One table of sketches for the rows of several, such as those of each day."""
    together = stored[0]
    for other in stored[1:]:
        together = together.unionByName(other)
    return together.groupBy("group").agg(
        F.sum("n").alias("n"), F.expr("kll_merge_agg_double(sketch)").alias("sketch")
    )


def exact_group_quantiles(
    df: DataFrame,
    group: str,
    column: str,
    probabilities: Sequence[float],
    sketches: DataFrame | None = None,
    slack: float = SLACK,
) -> DataFrame:
    """``group, n, quantiles``: an array in the order of ``probabilities``, for each group.

    Quantiles lie linearly between the neighbouring ranks. Groups without values have no row.
    ``df`` is read several times, so it should be a stored table. ``sketches`` are those of exactly
    these rows, if they are stored already.
    """
    value = F.col(column).cast("double")
    values = df.select(F.col(group).alias("group"), value.alias("v"))
    values = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    known = group_sketches(df, group, column) if sketches is None else sketches
    lower = F.array(*[F.lit(max(0.0, p - slack)) for p in probabilities])
    upper = F.array(*[F.lit(min(1.0, p + slack)) for p in probabilities])
    ends = known.select(
        "group",
        "n",
        F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), lower).alias("left"),
        F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), upper).alias("right"),
    )
    wanted = [
        F.struct(
            F.lit(i).alias("i"),
            (F.lit(p) * (F.col("n") - 1)).alias("position"),
            F.get("left", F.lit(i)).alias("left"),
            F.get("right", F.lit(i)).alias("right"),
        )
        for i, p in enumerate(probabilities)
    ]
    intervals = materialize(
        ends.select("group", "n", F.array(*wanted).alias("wanted")), "quantile-intervals"
    )
    found = materialize(_ranked(values, intervals), "group-quantiles")
    missed = found.where("missed")
    if not missed.isEmpty():
        everything = F.struct(
            F.col("i"), F.col("position"),
            F.lit(float("-inf")).alias("left"), F.lit(float("inf")).alias("right"),
        )
        again = missed.groupBy("group", "n").agg(F.collect_list(everything).alias("wanted"))
        found = found.where("NOT missed").unionByName(_ranked(values, again))
    pairs = F.array_sort(F.collect_list(F.struct("i", "quantile")))
    return found.groupBy("group", "n").agg(F.transform(pairs, lambda e: e["quantile"]).alias("quantiles"))


def _ranked(values: DataFrame, intervals: DataFrame) -> DataFrame:
    """``group, n, i, position, quantile, missed``: the values of the wanted ranks.

    Equal values are counted before the shuffle, and all below an interval as one.
    """
    near = intervals.select(F.col("group").alias("of"), "n", "wanted")
    each = values.join(near, F.col("group").eqNullSafe(F.col("of"))).select(
        "group", "n", "v", F.inline("wanted")
    )
    inside = F.when(F.col("v") >= F.col("left"), F.col("v"))
    counted = (
        each.where(F.col("v") <= F.col("right"))
        .groupBy("group", "n", "i", "position", inside.alias("v"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    running = Window.partitionBy("group", "i").orderBy(F.col("v").asc_nulls_first())
    upto = F.sum("rows").over(running.rowsBetween(Window.unboundedPreceding, 0))
    rank = F.floor("position")
    last = F.least(rank + 1, F.col("n") - 1)
    at = F.when(F.col("v").isNotNull() & (F.col("upto") > F.col("rank")), F.col("v"))
    after = F.when(F.col("v").isNotNull() & (F.col("upto") > F.col("last")), F.col("v"))
    summed = (
        counted.withColumn("upto", upto)
        .withColumns({"rank": rank, "last": last})
        .groupBy("group", "n", "i", "position")
        .agg(
            F.min(at).alias("low"),
            F.min(after).alias("high"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("rows"))), F.lit(0)).alias("below"),
        )
    )
    # A rank below the interval would be given the interval's first value.
    missed = (F.col("below") > rank) | F.col("low").isNull() | F.col("high").isNull()
    part = F.col("position") - rank
    quantile = F.col("low") + (F.col("high") - F.col("low")) * part
    return summed.select(
        "group", "n", "i", "position", F.when(~missed, quantile).alias("quantile"), missed.alias("missed")
    )
