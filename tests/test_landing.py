import json

import pytest

from reviewlab import schemas
from reviewlab.sources import landing


def record(i, **changes):
    return {
        "review_id": f"r{i}",
        "reviewer": "ann",
        "movie": "film",
        "rating": "8",
        "review_summary": "s",
        "review_date": "1 May 2020",
        "spoiler_tag": 0,
        "review_detail": "line one\nline \"two\"",
        "helpful": ["1", "2"],
    } | changes


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    without = record(2)
    del without["helpful"]
    first = [record(1), record(1), without]
    (path / "a.json").write_text(json.dumps(first, indent=1))
    (path / "b.json").write_text(json.dumps([record(3, rating=None), record(4, rating=7)]))
    return str(path)


def test_folders_inside_the_folder_count(spark, folder, tmp_path):
    inner = tmp_path / "in" / "sub"
    inner.mkdir()
    (inner / "b.json").write_text(json.dumps([record(8), record(9)]))
    assert len(review_ids(land(spark, folder, tmp_path))) == 7
    chosen = land(spark, folder, tmp_path, mode="select", files=["sub/b.json"])
    assert review_ids(chosen) == ["r8", "r9"]
    chosen = land(spark, folder, tmp_path, mode="select", files=["b.json"])
    assert review_ids(chosen) == ["r3", "r4"]


def land(spark, folder, tmp_path, **options):
    return landing.land_raw(spark, folder, str(tmp_path / "out"), **options)


def review_ids(df):
    return sorted(r["review_json"]["review_id"] for r in df.collect())


def test_arrays_of_all_files_become_rows(spark, folder, tmp_path):
    landed = land(spark, folder, tmp_path)
    assert landed.schema == schemas.RAW
    assert review_ids(landed) == ["r1", "r1", "r2", "r3", "r4"]
    rows = {r["review_json"]["review_id"]: r["review_json"] for r in landed.collect()}
    assert rows["r2"]["helpful"] is None and rows["r1"]["helpful"] == ["1", "2"]
    assert rows["r3"]["rating"] is None and rows["r4"]["rating"] == "7"
    assert rows["r1"]["review_detail"] == "line one\nline \"two\""


def test_selected_files(spark, folder, tmp_path):
    files = landing.parse_file_list(" b.json, ")
    landed = land(spark, folder, tmp_path, mode="select", files=files)
    assert review_ids(landed) == ["r3", "r4"]


def test_missing_files_are_named(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError, match="c.json"):
        land(spark, folder, tmp_path, mode="select", files=["a.json", "c.json"])
    with pytest.raises(FileNotFoundError):
        land(spark, folder, tmp_path, mode="select", files=[])


def test_empty_or_absent_folder(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("empty", "absent"):
        with pytest.raises(FileNotFoundError):
            land(spark, str(tmp_path / name), tmp_path)


def test_unknown_options(spark, folder, tmp_path):
    for options in ({"mode": "part"}, {"layout": "xml"}, {"if_exists": "append"}):
        with pytest.raises(ValueError):
            land(spark, folder, tmp_path, **options)


def test_broken_json_fails(spark, folder, tmp_path):
    with open(f"{folder}/bad.json", "w") as file:
        file.write('[{"review_id": "x", ')
    with pytest.raises(Exception, match="(?i)malformed"):
        land(spark, folder, tmp_path)


def test_reuse_of_a_complete_landing_only(spark, folder, tmp_path):
    land(spark, folder, tmp_path)
    with open(f"{folder}/c.json", "w") as file:
        json.dump([record(9)], file)
    reused = land(spark, folder, tmp_path, if_exists="reuse")
    assert "r9" not in review_ids(reused)
    (tmp_path / "out" / "raw_full" / "_SUCCESS").unlink()
    assert "r9" in review_ids(land(spark, folder, tmp_path, if_exists="reuse"))
    with open(f"{folder}/d.json", "w") as file:
        json.dump([record(10)], file)
    assert "r10" in review_ids(land(spark, folder, tmp_path, if_exists="overwrite"))


def test_lines_layout_takes_objects_and_arrays(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    lines = [json.dumps(record(1)), json.dumps([record(2), record(3)])]
    (path / "a.json").write_text("\n".join(lines))
    landed = land(spark, str(path), tmp_path, layout="lines")
    assert review_ids(landed) == ["r1", "r2", "r3"]


def lines(*numbers):
    return "".join(json.dumps(record(i)) + "\n" for i in numbers)


def test_each_new_file_once(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "out")
    (source / "deep").mkdir(parents=True)
    (source / "a.json").write_text(lines(1, 1, 2))
    assert review_ids(landing.land_new(spark, str(source), base)) == ["r1", "r1", "r2"]
    (source / "deep" / "b.json").write_text(lines(3))
    # Older than all others, and with the name of another file in its folder.
    (source / "deep" / "a.json").write_text(lines(4))
    import os

    os.utime(source / "deep" / "a.json", (1, 1))
    for _ in range(2):
        landed = landing.land_new(spark, str(source), base, files_at_once=1)
        assert review_ids(landed) == ["r1", "r1", "r2", "r3", "r4"]
    (source / "a.json").write_text(lines(7))
    assert len(review_ids(landing.land_new(spark, str(source), base))) == 5


def test_a_failed_landing_goes_on(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.json").write_text(lines(1, 2))
    landing.land_new(spark, str(source), base)
    (source / "b.json").write_text(lines(3))
    (source / "c.json").write_text("{broken\n")
    with pytest.raises(Exception):  # noqa: B017
        landing.land_new(spark, str(source), base)
    (source / "c.json").write_text(lines(4, 5))
    assert review_ids(landing.land_new(spark, str(source), base)) == [f"r{i}" for i in range(1, 6)]


def test_new_array_files_and_blobs(spark, folder, tmp_path):
    landed = landing.land_new(spark, folder, str(tmp_path / "out"), layout="array")
    assert review_ids(landed) == ["r1", "r1", "r2", "r3", "r4"]
    with pytest.raises(ValueError):
        landing.land_new(spark, folder, str(tmp_path / "out2"), layout="split")
    texts = tmp_path / "blobs"
    texts.mkdir()
    (texts / "a").write_text('{"a": 1}\n\n  \n{"a": 2}\n')
    for more in ("b", "c"):
        blobs = landing.land_new_blobs(spark, str(texts), str(tmp_path / "out3"))
        (texts / more).write_text('{"a": 3}\n')
    assert sorted(r["json_blob"] for r in blobs.collect()) == ['{"a": 1}', '{"a": 2}', '{"a": 3}']
