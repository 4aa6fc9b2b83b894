import pytest

from reviewlab import schemas
from reviewlab.functions import text
from reviewlab.operators.clean import clean_reviews, flatten_reviews, rating_category_counts
from pyspark.sql import functions as F


def review(review_id, rating="7", detail="x" * 1000):
    return (review_id, "anna", "film", rating, "s", "2024-01-01", 0, detail, ["1", "2"])


def cleaned(spark, rows, **options):
    flat = spark.createDataFrame(rows, schemas.FLAT)
    return {r["review_id"]: r for r in clean_reviews(flat, **options).collect()}


@pytest.mark.parametrize(
    "rating, category",
    [
        ("7", 3.0),
        ("10", 3.0),
        ("6.66", 2.0),
        ("6.67", 3.0),
        ("3.33", 1.0),
        ("3.34", 2.0),
        ("0", 1.0),
        (" 5 ", 2.0),
        ("-1", None),
        ("Null", None),
        ("", None),
        (None, None),
        ("NaN", None),
    ],
)
def test_rating_category(spark, rating, category):
    rows = cleaned(spark, [review("a", rating)])
    assert (rows["a"]["rating_category"] if rows else None) == category


def test_lengths_count_after_cleaning(spark):
    rows = [
        review("999", detail="a" * 999),
        review("1000", detail="a" * 1000),
        review("punctuation", detail="a" * 999 + "!!!!"),
        review("kept blanks", detail=" " * 500 + "b" * 500),
        review("null", detail=None),
        review("empty", detail=""),
    ]
    assert set(cleaned(spark, rows)) == {"1000", "kept blanks"}


def test_cleaning_deletes_all_but_ascii_letters_digits_and_blanks(spark):
    detail = "Don't\tgo.\nNext_café  ÀB 9½"
    row = cleaned(spark, [review("a", detail=detail)], min_chars=5)["a"]
    assert row["review_detail"] == "DontgoNextcaf  B 9"
    assert row["cleaned_review"] == "dontgonextcaf  b 9"


def test_punctuation_pattern_over_all_of_latin_1_and_beyond(spark):
    characters = "".join(map(chr, range(1, 0x250))) + "世界😀"
    kept = spark.range(1).select(text.strip_punctuation(F.lit(characters))).first()[0]
    assert kept == "".join(c for c in characters if c == " " or (c.isascii() and c.isalnum()))


def test_schema_and_flatten(spark):
    raw = spark.createDataFrame([(review("a"),), (review("b", "2"),)], schemas.RAW)
    flat = flatten_reviews(raw)
    assert flat.schema == schemas.FLAT
    out = clean_reviews(flat)
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.CLEANED
    ]
    counts = {r["rating_category"]: r["reviews"] for r in rating_category_counts(out).collect()}
    assert counts == {3.0: 1, 1.0: 1}


def test_text_is_cleaned_once_and_null_ratings_leave_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.createDataFrame([review("a")], schemas.FLAT).write.parquet(path)
    plan = clean_reviews(spark.read.schema(schemas.FLAT).parquet(path))
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert text_plan.count("regexp_replace") == 1
    assert "IsNotNull(rating)" in text_plan
    assert "BatchEvalPython" not in text_plan and "ArrowEvalPython" not in text_plan
