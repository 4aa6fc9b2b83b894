from pyspark.sql import functions as F

from reviewlab.operators import sampling

SCHEMA = "review_id string, rating_category float, text string"


def splits(df):
    rows = sampling.stratified_split(df).collect()
    return sorted((str(r["review_id"]), str(r["rating_category"]), r["text"], r["split"]) for r in rows)


def test_every_class_has_its_share(spark):
    sizes = {1.0: 1, 2.0: 12, 3.0: 5000, None: 33}
    rows = [(f"{c}-{i}", c, "t") for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sampling.stratified_split(df)
    assert found.columns == [*df.columns, "split"] and found.count() == len(rows)
    train = found.groupBy("rating_category").agg(F.count_if(F.col("split") == "train").alias("n"))
    counts = {r["rating_category"]: r["n"] for r in train.collect()}
    assert counts == {c: 4 * (n - 1) // 5 + 1 for c, n in sizes.items()}
    assert splits(df) == splits(df.repartition(7, "text"))


def test_missing_and_repeated_keys(spark):
    rows = [(None, 1.0, f"text {i}") for i in range(50)] + [("same", 1.0, "a"), ("same", 1.0, "b")]
    found = splits(spark.createDataFrame(rows, SCHEMA))
    assert len(found) == 52 and len({s for key, *_, s in found if key == "same"}) == 1
    assert 35 <= sum(s == "train" for *_, s in found) <= 45
    assert splits(spark.createDataFrame([], SCHEMA)) == []
