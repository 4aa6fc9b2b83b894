"""Landing of raw JSON reviews as one parquet table with the column ``review_json``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from reviewlab import schemas
from reviewlab.sinks.writers import write_parquet
from reviewlab.sources.arrays import read_json_arrays
from reviewlab.sources.tables import read_raw

FULL, SELECT = "full", "select"
ARRAY, LINES, SPLIT = "array", "lines", "split"
#: File names that are looked up in one pass over the listing.
NAMES_AT_ONCE = 200


def parse_file_list(text: str) -> list[str]:
    """File names from a comma-separated list."""
    return [name.strip() for name in text.split(",") if name.strip()]


def source_paths(
    spark: SparkSession, folder: str, mode: str = FULL, files: Sequence[str] = ()
) -> list[str]:
    """The paths to read: the folder itself, or the selected files, all of which must exist.

    Folders inside the folder count, in FULL mode with all their files, in SELECT mode by names
    like ``sub/b.json``. The listing reads file names only, not their contents.
    """
    if mode not in (FULL, SELECT):
        raise ValueError(f"unknown mode {mode!r}")
    try:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"no files in {folder}") from error
    paths = listing.select("path")
    if mode == FULL:
        if paths.isEmpty():
            raise FileNotFoundError(f"no files in {folder}")
        return [folder]
    wanted = list(dict.fromkeys(files))
    if not wanted:
        raise FileNotFoundError("no files selected")
    inside = folder.rstrip("/").rsplit("/", 1)[-1]
    missing = []
    for start in range(0, len(wanted), NAMES_AT_ONCE):
        some = wanted[start : start + NAMES_AT_ONCE]
        ends = [F.bool_or(F.col("path").endswith(f"/{inside}/{name}")) for name in some]
        missing += [name for name, there in zip(some, paths.agg(*ends).first()) if not there]
    if missing:
        raise FileNotFoundError(f"not in {folder}: {', '.join(missing)}")
    return [f"{folder}/{name}" for name in wanted]


def read_json_reviews(
    spark: SparkSession, paths: Sequence[str], layout: str = ARRAY
) -> DataFrame:
    """Reviews of all files, one struct per row; duplicates stay.

    ``array``: each file is one JSON array. Spark cannot split such a file, so one task reads
    it whole; keep these files small (up to some hundred MB) and numerous. ``lines``: one
    object, or one array, per line; such files are split and may have any size. ``split``: like
    ``array``, but every file is read by as many tasks as its size asks for (``sources.arrays``).
    Broken JSON fails the read in all layouts. Files in folders below the paths are read too.
    """
    if layout == SPLIT:
        rows = read_json_arrays(spark, paths, schemas.REVIEW)
        return rows.select(F.struct("*").alias("review_json"))
    reader = spark.read.schema(schemas.REVIEW).option("mode", "FAILFAST")
    reader = reader.option("recursiveFileLookup", True)
    if layout == ARRAY:
        reader = reader.option("multiLine", True)
    elif layout != LINES:
        raise ValueError(f"unknown layout {layout!r}")
    return reader.json(list(paths)).select(F.struct("*").alias("review_json"))


def raw_path(base: str, mode: str) -> str:
    return f"{base}/raw_{mode}"


def land_raw(
    spark: SparkSession,
    folder: str,
    base: str,
    mode: str = FULL,
    files: Sequence[str] = (),
    layout: str = ARRAY,
    if_exists: str = "overwrite",
) -> DataFrame:
    """Land JSON reviews below ``base`` and return the landed table.

    With ``if_exists="reuse"`` a complete earlier landing of the same mode is returned as it
    is; a select landing is only good for the same files, so it is always written anew.
    """
    if if_exists not in ("overwrite", "reuse"):
        raise ValueError(f"unknown if_exists {if_exists!r}")
    target = raw_path(base, mode)
    paths = source_paths(spark, folder, mode, files)
    if not (if_exists == "reuse" and mode == FULL and is_complete(spark, target)):
        write_parquet(read_json_reviews(spark, paths, layout), target)
    return read_raw(spark, target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its success marker in the folder.

    Spark's readers hide files whose names begin with an underscore, so the file system is
    asked directly.
    """
    context = spark.sparkContext
    marker = context._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(context._jsc.hadoopConfiguration()).exists(marker)


#: Files are taken in by their names, however old they are.
ANY_AGE = "36500d"


def land_new(
    spark: SparkSession,
    folder: str,
    base: str,
    layout: str = LINES,
    files_at_once: int | None = None,
) -> DataFrame:
    """Land the files that have come into ``folder`` since the last call, and return all of them.

    A stream reads each file once: its checkpoint below ``base`` knows the files that are done, and the
    landed table lists the parts that count, so a job that dies halfway leaves neither a gap nor a
    row twice. A file that is written again under the same name is not read again. Broken JSON
    fails the call; once the file is mended, or taken away, the next call goes on. ``files_at_once``
    bounds what one step of the stream reads. Folders inside the folder count.
    """
    reader = spark.readStream.schema(schemas.REVIEW).option("mode", "FAILFAST")
    if layout == ARRAY:
        reader = reader.option("multiLine", True)
    elif layout != LINES:
        raise ValueError(f"layout {layout!r} cannot be streamed")
    rows = _arriving(reader, files_at_once).json(folder)
    return _land_stream(rows.select(F.struct("*").alias("review_json")), f"{base}/raw_new")


def land_new_blobs(
    spark: SparkSession, folder: str, base: str, files_at_once: int | None = None
) -> DataFrame:
    """The same for files with one JSON object per line, landed as ``json_blob``."""
    lines = _arriving(spark.readStream, files_at_once).text(folder)
    blobs = lines.select(F.col("value").alias("json_blob")).where("trim(json_blob) <> ''")
    return _land_stream(blobs, f"{base}/blobs_new")


def _arriving(reader: DataStreamReader, files_at_once: int | None) -> DataStreamReader:
    reader = reader.option("recursiveFileLookup", True).option("maxFileAge", ANY_AGE)
    return reader if files_at_once is None else reader.option("maxFilesPerTrigger", files_at_once)


def _land_stream(rows: DataFrame, target: str) -> DataFrame:
    """Run the stream until it has nothing left to read."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{target}_state")
    query = writer.option("path", target).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return rows.sparkSession.read.schema(rows.schema).parquet(target)
