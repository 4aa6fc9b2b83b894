import json

from reviewlab import schemas
from reviewlab.operators import catalogue
from reviewlab.plans.catalogue import build_catalogue
from reviewlab.sinks import writers
from reviewlab.sources import tables


def blob(track, artist=1, name="ann", **changes):
    return json.dumps(
        {
            "track_id": track,
            "track_name": f"t{track}",
            "track_price": 1.5,
            "collection_id": track // 2,
            "collection_name": f"c{track // 2}",
            "artist_id": artist,
            "artist_name": name,
        }
        | changes
    )


def blobs(spark, values):
    return spark.createDataFrame([(v,) for v in values], schemas.BLOB)


BAD = ["not json", "{", "[1", '{"track_id": "x"}', None]


def test_parse_splits_good_from_bad(spark):
    good, bad = catalogue.parse_blobs(blobs(spark, [blob(1), blob(2, extra=3), *BAD]))
    assert good.schema == schemas.TRACK_RECORD
    assert sorted(r["track_id"] for r in good.collect()) == [1, 2]
    assert {r["json_blob"] for r in bad.collect()} == set(BAD)


def test_entities_have_one_row_per_key(spark):
    values = [blob(1), blob(1), blob(2), blob(3, 2, "bob"), blob(4, 2, "al"), blob(5, None)]
    good, _ = catalogue.parse_blobs(blobs(spark, values))
    assert sorted(r["track_id"] for r in catalogue.split_tracks(good).collect()) == [1, 2, 3, 4, 5]
    artists = {r["artist_id"]: r["artist_name"] for r in catalogue.split_artists(good).collect()}
    assert artists == {1: "ann", 2: "al"}
    collections = catalogue.split_collections(good).collect()
    assert sorted(tuple(r) for r in collections) == [(0, "c0"), (1, "c1"), (2, "c2")]


def test_concat_keeps_duplicates_and_takes_nothing(spark):
    one = blobs(spark, [blob(1)])
    assert catalogue.concat_tables(spark, [one, one, blobs(spark, [])]).count() == 2
    empty = catalogue.concat_tables(spark, [])
    assert empty.schema == schemas.BLOB and empty.count() == 0


def test_json_round_trip(spark):
    good, _ = catalogue.parse_blobs(blobs(spark, [blob(1), blob(2, artist_name='a "b" \n')]))
    again, bad = catalogue.parse_blobs(catalogue.to_json_blobs(good))
    assert sorted(again.collect()) == sorted(good.collect()) and bad.count() == 0


def test_catalogue_job(spark, tmp_path):
    for name, lines in {"x": [blob(1), blob(2), ""], "y": [blob(2), "bad"]}.items():
        (tmp_path / name).write_text("\n".join(lines))
    base = str(tmp_path / "out")
    build_catalogue(spark, [str(tmp_path / "x"), str(tmp_path / "y")], base)
    assert spark.read.parquet(f"{base}/blobs").count() == 4
    assert spark.read.parquet(f"{base}/records").count() == 3
    assert spark.read.parquet(f"{base}/tracks").count() == 2
    assert spark.read.parquet(f"{base}/artists").count() == 1
    assert [r[0] for r in spark.read.parquet(f"{base}/rejected_blobs").collect()] == ["bad"]


WORDS = [("", 5), (None, 4), ("a,b", 3), ('q"uote', 2), ("back\\", 1), ("\\N?", 0), ("new\nline", 9)]


def test_csv_keeps_every_row_and_value(spark, tmp_path):
    rows = [*WORDS, ("bo\nb", 2), ("\r\n,\"", 3), ("\n", 4)]
    path = str(tmp_path / "csv")
    writers.write_csv_report(spark.createDataFrame(rows, schemas.WORD_COUNTS), path, True)
    files = list((tmp_path / "csv").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("word,count\n")
    assert set(map(tuple, tables.read_csv_report(spark, path, schemas.WORD_COUNTS).collect())) == set(
        rows
    )


def test_lines_that_do_not_fit_are_skipped(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.csv").write_text("word,count\na,1\nb,many\nc,2,3\nd,4\n")
    (tmp_path / "r" / "b.csv").write_text("word,count\ne,5\n")
    rows = tables.read_csv_report(spark, str(tmp_path / "r"), schemas.WORD_COUNTS).collect()
    assert sorted(r["word"] for r in rows) == ["a", "d", "e"]


def test_small_reports_are_single_files_and_are_replaced(spark, tmp_path):
    for n in (50, 7):
        df = spark.range(n).selectExpr("cast(id as string) as line").repartition(4)
        writers.write_small_parquet(df, str(tmp_path / "p"))
        writers.write_text_report(df, str(tmp_path / "t"))
    assert len(list((tmp_path / "p").glob("part-*.parquet"))) == 1
    assert len(list((tmp_path / "t").glob("part-*.txt"))) == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 7
    assert spark.read.text(str(tmp_path / "t")).count() == 7


def test_sorted_reports_keep_their_order(spark, tmp_path):
    df = spark.range(500).selectExpr("cast(id as string) as word", "id as count").orderBy("count")
    writers.write_csv_report(df, str(tmp_path / "s"))
    files = sorted((tmp_path / "s").glob("part-*.csv"))
    numbers = [
        int(line.split(",")[1]) for f in files for line in f.read_text().splitlines()[1:]
    ]
    assert numbers == list(range(500))


def test_spread_only_touches_scans_with_few_partitions(spark):
    few, many = spark.range(0, 10, 1, 1), spark.range(0, 10, 1, 64)
    assert tables.spread(few, "id").rdd.getNumPartitions() == 4
    assert tables.spread(many, "id") is many
