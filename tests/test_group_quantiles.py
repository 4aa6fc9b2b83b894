"""Quantiles of all groups at once, next to numpy on each group."""

import math
import random

import numpy as np
import pytest

from reviewlab.operators import reports
from reviewlab.operators.group_quantiles import (
    exact_group_quantiles,
    group_sketches,
    merge_sketches,
)

POINTS = (0.0, 0.25, 0.5, 0.9, 1.0)
SCHEMA = "movie string, length double"


def expected(rows):
    groups = {}
    for name, value in rows:
        if value is not None and not math.isnan(value):
            groups.setdefault(name, []).append(value)
    return {name: np.quantile(values, POINTS).tolist() for name, values in groups.items()}


def found(df, **options):
    table = exact_group_quantiles(df, "movie", "length", POINTS, **options)
    rows = table.collect()
    assert len({r["group"] for r in rows}) == len(rows)
    return {r["group"]: r["quantiles"] for r in rows}


def agree(mine, theirs):
    assert mine.keys() == theirs.keys()
    for name, values in mine.items():
        assert values == pytest.approx(theirs[name], abs=1e-9), name


@pytest.fixture(scope="module")
def rows():
    """One hot group, one of equal values, one of two heavy values, small ones, odd rows."""
    draw = random.Random(5)
    made = [("hot", draw.gauss(0, 100)) for _ in range(30_000)]
    made += [("same", 7.0)] * 3000
    made += [("two", float(draw.random() < 0.5)) for _ in range(3001)]
    made += [(f"m{i}", float(draw.randint(0, 9))) for i in range(40) for _ in range(i % 7 + 1)]
    made += [(None, 1.0), (None, 4.0), ("null only", None), ("nan only", math.nan)]
    made += [("same", None), ("two", math.nan), ("", -1.5)]
    draw.shuffle(made)
    return made


def test_equal_to_numpy(spark, rows):
    agree(found(spark.createDataFrame(rows, SCHEMA).repartition(6)), expected(rows))


def test_missed_intervals_are_counted_again(spark, rows):
    """Without slack many ranks lie outside what the sketch gives for them."""
    agree(found(spark.createDataFrame(rows, SCHEMA), slack=0.0), expected(rows))


def test_stored_sketches_merge(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    days = [spark.createDataFrame(rows[i::3], SCHEMA) for i in range(3)]
    merged = merge_sketches(*[group_sketches(day, "movie", "length") for day in days])
    agree(found(df, sketches=merged), expected(rows))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    assert reports.group_boxes(spark.createDataFrame([], SCHEMA), "movie", "length").count() == 0


def test_boxes_are_those_of_each_group(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    boxes = {r["movie"]: r.asDict() for r in reports.group_boxes(df, "movie", "length").collect()}
    assert None in boxes and "null only" not in boxes
    for name in ("hot", "same", "two", "m6"):
        one = df.where(df["movie"] == name).where("NOT isnan(length)")
        alone = reports.box_summary(one, "length").first().asDict()
        assert {k: boxes[name][k] for k in alone} == pytest.approx(alone)
