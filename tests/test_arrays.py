"""Array files read in ranges, next to Spark's reader of whole files."""

import json
import random
from collections import Counter

import pytest

from reviewlab import schemas
from reviewlab.sources import arrays, landing


@pytest.fixture
def small_ranges(spark):
    """Ranges of 64 bytes or so, far smaller than an element."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    for name in names:
        spark.conf.set(name, "64")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


NASTY = ['a "quoted" word', "}{][", "back\\slash\\\\", 'end\\"}', "}, {", "é ü 漢字 \U0001f600", "", "\n\t}", "\\", '"', "[1, 2}"]


def review(rng, i):
    texts = [" ".join(rng.choices(NASTY, k=rng.randrange(6))) for _ in range(4)]
    row = {"review_id": str(i), "reviewer": texts[0], "movie": texts[1], "rating": rng.choice(["8", 7, None])}
    row |= {"review_detail": texts[2] * rng.choice((1, 1, 9)), "spoiler_tag": i % 2, "extra": {"a": [{"b": texts[3]}, {}]}}
    if rng.random() < 0.7:
        row["helpful"] = rng.choices(NASTY, k=rng.randrange(3))
    return row


def counted(frame):
    return Counter(json.dumps(row.asDict(recursive=True), sort_keys=True) for row in frame.collect())


def both(spark, paths):
    split = landing.read_json_reviews(spark, paths, landing.SPLIT)
    return counted(split), counted(landing.read_json_reviews(spark, paths, landing.ARRAY))


def test_same_rows_as_one_task_per_file(spark, small_ranges, tmp_path):
    rng = random.Random(6)
    forms = [{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}]
    for number, form in enumerate(forms):
        rows = [review(rng, i) for i in range(25)]
        (tmp_path / f"{number}.json").write_text(json.dumps(rows, **form), encoding="utf-8")
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "none.json").write_text("[ ]\n")
    (tmp_path / "inner" / "one.json").write_text("\n [ " + json.dumps(review(rng, 99)) + "]\n\n")
    split, whole = both(spark, [str(tmp_path)])
    assert split == whole and sum(split.values()) == 101
    found = arrays.chunks(spark, [str(tmp_path / "1.json")])
    assert found.rdd.getNumPartitions() > 20
    assert found.select("start").distinct().count() > 20


def test_file_of_one_object(spark, small_ranges, tmp_path):
    row = review(random.Random(1), 5)
    for name, text in (("a.json", json.dumps(row)), ("b.json", json.dumps(row, indent=1) + "\n")):
        (tmp_path / name).write_text(text)
        split, whole = both(spark, [str(tmp_path / name)])
        assert split == whole and sum(split.values()) == 1


def test_one_large_element_over_many_ranges(spark, small_ranges, tmp_path):
    rows = [{"review_id": "1", "review_detail": '} "{' * 2000}, {"review_id": "2"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    split, whole = both(spark, [str(tmp_path)])
    assert split == whole and sum(split.values()) == 2


@pytest.mark.parametrize(
    "text",
    ['[{"review_id": "1"}', '[{"review_id": "1}]', '[{"review_id": "1"}\n', '[{"review_id": {"1"}]', "[1, 2]", '[{"review_id" "1"}]', '["a}b"]'],
)
def test_broken_files_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        arrays.read_json_arrays(spark, [str(tmp_path)], schemas.REVIEW).collect()


def test_too_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "MAX_RANGES", 1)
    for name in "ab":
        (tmp_path / f"{name}.json").write_text("[{}]")
    with pytest.raises(ValueError, match="ranges"):
        arrays.array_elements(spark, [str(tmp_path)])
