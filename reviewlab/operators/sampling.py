"""Splits and caps that depend on the row's id, not on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.functions.text import split_bucket
from reviewlab.operators.group_quantiles import exact_group_quantiles

# Fixed value: share of the training rows, in percent.
TRAIN_PERCENT = 80


def hash_split(
    df: DataFrame, key: str = "review_id", train_percent: int = TRAIN_PERCENT
) -> DataFrame:
    """Add ``split``, ``train`` or ``test``; equal keys always get the same one.

    Rows without a key are split by the hash of their other columns of numbers and texts.
    """
    others = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spare = F.xxhash64(F.lit(0), *[F.col(c) for c in others if c != key]).cast("string")
    is_train = split_bucket(F.coalesce(F.col(key), spare)) < train_percent
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def stratified_split(
    df: DataFrame,
    stratum: str = "rating_category",
    key: str = "review_id",
    train_percent: int = TRAIN_PERCENT,
) -> DataFrame:
    """Add ``split`` so that each stratum has its share of training rows to within one row.

    In every stratum the rows up to the wanted quantile of the hash of their key are for training;
    the quantiles of all strata are found together. Rows with equal keys, and those of the same
    stratum without a key but with equal other columns, get the same split. Rows without a stratum
    are one of their own. ``df`` is read several times, so it should be a stored table.
    """
    others = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spare = F.xxhash64(F.lit(0), *[F.col(c) for c in others if c != key]).cast("string")
    name = F.coalesce(F.col(key).cast("string"), spare)
    # 48 bits, so that a value between two neighbours is not rounded to one of them.
    place = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double")
    hashed = df.select(F.col(stratum).alias("stratum"), place.alias("place"))
    found = exact_group_quantiles(hashed, "stratum", "place", [train_percent / 100])
    upto = found.select(F.col("group").alias("_stratum"), F.get("quantiles", F.lit(0)).alias("_upto"))
    joined = df.join(upto, F.col(stratum).eqNullSafe(F.col("_stratum")))
    is_train = place <= F.col("_upto")
    split = F.when(is_train, "train").otherwise("test")
    return joined.withColumn("split", split).drop("_stratum", "_upto")


def cap_rows(df: DataFrame, n: int, key: str = "review_id") -> DataFrame:
    """A reproducible sample of ``n`` rows (all if fewer): the first by the hash of their key,
    then the key, then the other plain columns from left to right.

    A null key hashes like an empty one. Rows that are equal in all these columns cannot be told
    apart, so any of them fill up the number. ``orderBy().limit(n)`` over the whole table would
    send up to ``n`` rows of every partition to one task. The hash is uniform, so a threshold on
    it leaves little more than ``n`` rows; the cut-off is taken from these and then filters the
    table in place.
    """
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if total <= n:
        return df
    hashed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    # Five standard deviations and a few rows more than the n wanted.
    share = min(1.0, (n + 5.0 * n**0.5 + 25.0) / total)
    while True:
        few = df if share >= 1.0 else df.where(hashed < _hash_below(share))
        if share >= 1.0 or few.count() >= n:
            break
        share = min(1.0, share * 2)
    columns = [key, *_plain_columns(df, key)]
    place = F.struct(hashed.alias("hash"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    last = few.select(place.alias("place")).orderBy("place").offset(n - 1).limit(1)
    last = last.select(F.to_json("place", {"ignoreNullFields": "false"}).alias("json")).first()
    at = F.from_json(F.lit(last["json"]), few.select(place.alias("place")).schema["place"].dataType)
    before, ties = df.where(place < at), df.where(place == at)
    wanted = n - before.count()
    if ties.count() == wanted:
        return df.where(place <= at)
    return before.unionByName(ties.limit(wanted))


def _plain_columns(df: DataFrame, key: str) -> list[str]:
    """The columns besides the key that hold text, whole numbers or booleans."""
    plain = (T.StringType, T.IntegralType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, plain)]


def _hash_below(share: float) -> Column:
    return F.lit(f"{int(share * 2**52):013x}")
