"""The files that the landing queries write are dealt over tasks."""

import json
from pathlib import Path

from pyspark.sql import functions as F

from checks import queries
from reviewlab import schemas
from reviewlab.sources import arrays, landing


def test_large_arrays_are_several_files(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").cast("string").alias("review_id"))
    rows = rows.unionByName(rows.where("review_id < '2'"))
    lines = rows.select(F.to_json(F.struct("review_id")).alias("value"))
    queries.write_arrays(lines, str(tmp_path / "many"), 1000)
    files = [p for p in Path(tmp_path / "many").rglob("part-*") if p.suffix != ".crc"]
    assert len(files) > 3
    held = [e["review_id"] for p in files for e in json.loads(p.read_text())]
    assert sorted(held) == sorted(r["review_id"] for r in rows.collect())
    read = arrays.read_json_arrays(spark, [str(tmp_path / "many")], schemas.REVIEW)
    assert sorted(r["review_id"] for r in read.collect()) == sorted(held)
    queries.write_arrays(lines.limit(0), str(tmp_path / "none"), 1000)
    (empty,) = Path(tmp_path / "none").rglob("part-*.txt")
    assert json.loads(empty.read_text()) == []


def test_a_selection_is_written_by_more_than_one_task(spark, monkeypatch):
    tables = "/root/testdata/sf0.001"
    names = []
    land = landing.land_raw

    def seen(spark, folder, base, mode, files, layout):
        names.extend(files)
        return land(spark, folder, base, mode, files, layout)

    monkeypatch.setattr(landing, "land_raw", seen)
    assert queries.land_select(spark, tables).count() > 0
    assert len(names) > 2 and all(not n.startswith("part1/") for n in names)
