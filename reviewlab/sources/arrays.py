"""JSON array files of any size, each read by many tasks.

Spark reads a file that holds one JSON array in one task. Here the file is cut at closing braces, which
the text reader can do at any byte range. A first pass finds for every range how many quotes it
holds and how deep it leads, under both guesses of whether it begins inside a string. Prefix sums over
the ranges tell which guess is right and how deep each begins. A second pass then takes out the
elements that lie in one range; what is left at the borders of ranges is put together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.session import materialize

#: Ranges of all files together that the second pass may look up; larger ranges
#: (spark.sql.files.maxPartitionBytes) are fewer.
MAX_RANGES = 1_000_000

#: What changes the state: an escaped character, a quote, a bracket.
MARKS = re.compile(r'\\.|["\[\]{}]', re.DOTALL)
BLANKS = " \t\n\r"
RANGE = ["path", "start"]


def chunks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, start, value``: the text between closing braces, in order inside each byte range.

    Behind every chunk stands a brace, but for what follows the last one of a file.
    """
    reader = spark.read.option("lineSep", "}").option("recursiveFileLookup", True)
    lines = reader.text(list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, dict]]:
    """(path, start, row) of each chunk."""
    for row in batch.to_pylist():
        yield row["path"], row["start"], row


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quotes of a range, the depth it adds if it begins outside or inside a string, and its first
    character that is no blank."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for path, start, row in ranges(batch):
            quotes, outside, inside, first = found.get((path, start), (0, 0, 0, None))
            if first is None:
                first = (row["value"].lstrip(BLANKS) + "}")[0]
            for mark in MARKS.findall(row["value"] + "}"):
                if mark == '"':
                    quotes += 1
                elif len(mark) == 1:
                    step = 1 if mark in "[{" else -1
                    if quotes % 2:
                        inside += step
                    else:
                        outside += step
            found[path, start] = [quotes, outside, inside, first]
    rows = [
        {"path": p, "start": s, "quotes": q, "outside": o, "inside": i, "first": f}
        for (p, s), (q, o, i, f) in found.items()
    ]
    yield pa.RecordBatch.from_pylist(rows, MEASURED_ARROW)


MEASURED = "path string, start long, quotes long, outside long, inside long, first string"
MEASURED_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("quotes", pa.int64()),
        ("outside", pa.int64()),
        ("inside", pa.int64()),
        ("first", pa.string()),
    ]
)


def entry_states(measured: DataFrame) -> DataFrame:
    """``path, start, quoted, depth, base``: the state in which each range begins. The base is the
    depth between elements: one inside an array, zero in a file of single objects."""
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    states = measured.withColumn("quoted", quoted)
    added = F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside"))
    states = states.withColumn("added", added)
    depth = F.coalesce(F.sum("added").over(before), F.lit(0))
    base = F.first("first").over(order) == "["
    return states.withColumn("depth", depth).withColumn("base", base.cast("int"))


def check_ends(states: DataFrame) -> None:
    """Every file must close what it opens. The brace that is added behind its last text is no
    part of it; only a file of single objects may end without such a text."""
    last = states.groupBy("path").agg(
        F.max_by(F.struct("quoted", "quotes", "depth", "added", "base"), "start").alias("e")
    )
    open_string = (F.col("e.quoted") + F.col("e.quotes")) % 2 == 1
    end = F.col("e.depth") + F.col("e.added")
    wrong = open_string | ~((end == -1) | ((end == 0) & (F.col("e.base") == 0)))
    broken = last.where(wrong).select("path").limit(3).collect()
    if broken:
        raise ValueError(f"broken JSON in {', '.join(row['path'] for row in broken)}")


ELEMENTS = "path string, start long, number long, kind string, text string"
ELEMENTS_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("start", pa.int64()),
        ("number", pa.int64()),
        ("kind", pa.string()),
        ("text", pa.string()),
    ]
)
WHOLE, TAIL, PIECE = "whole", "tail", "piece"
ROWS_AT_ONCE, TEXT_AT_ONCE = 4096, 4 << 20


class Cutter:
    """Elements of one range from its chunks. What an earlier range began comes first, as a PIECE;
    what is not ended here comes last, as a TAIL (or a PIECE if it began earlier)."""

    def __init__(self, path: str, start: int, quoted: int, depth: int, base: int):
        self.path, self.start = path, start
        self.quoted, self.depth, self.base = bool(quoted), depth, base
        self.began = depth > base  # inside an element
        self.earlier = self.began
        self.text: list[str] = []
        self.number = 0

    def row(self, kind: str) -> dict:
        self.number += 1
        text = "".join(self.text)
        self.text = []
        place = {"path": self.path, "start": self.start, "number": self.number}
        return place | {"kind": kind, "text": text}

    def add(self, chunk: str) -> Iterator[dict]:
        text, taken = chunk + "}", 0
        for mark in MARKS.finditer(text):
            sign = mark.group()
            if sign == '"':
                self.quoted = not self.quoted
            elif self.quoted or len(sign) > 1:
                continue
            elif sign in "[{":
                if not self.began and sign == "{" and self.depth == self.base:
                    self.reject(text[taken : mark.start()])
                    self.began, taken = True, mark.start()
                self.depth += 1
            else:
                self.depth -= 1
                if self.began and self.depth == self.base:
                    self.text.append(text[taken : mark.end()])
                    taken = mark.end()
                    yield self.row(PIECE if self.earlier else WHOLE)
                    self.began = self.earlier = False
        if self.began:
            self.text.append(text[taken:])
        else:
            self.reject(text[taken:])

    def reject(self, between: str) -> None:
        """Between elements stand commas, blanks and the array's own brackets (a brace: see chunks)."""
        if between.strip(BLANKS + ",[]}"):
            raise ValueError(f"{self.path}: only objects can be elements, not {between[:40]!r}")

    def end(self) -> Iterator[dict]:
        if self.began and self.text:
            yield self.row(PIECE if self.earlier else TAIL)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements, and pieces of them at the borders of ranges. A task may read several ranges."""

    def rows() -> Iterator[dict]:
        cutter = None
        for batch in batches:
            for path, start, row in ranges(batch):
                if cutter is None or (cutter.path, cutter.start) != (path, start):
                    if cutter is not None:
                        yield from cutter.end()
                    cutter = Cutter(path, start, row["quoted"], row["depth"], row["base"])
                yield from cutter.add(row["value"])
        if cutter is not None:
            yield from cutter.end()

    held, size = [], 0
    for row in rows():
        held.append(row)
        size += len(row["text"])
        if len(held) >= ROWS_AT_ONCE or size >= TEXT_AT_ONCE:
            yield pa.RecordBatch.from_pylist(held, ELEMENTS_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, ELEMENTS_ARROW)


def array_elements(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``text``: the objects of all files, each as it is written. Broken files raise an error.

    Ranges are those of the text reader, so a file is read by as many tasks as its size asks for. The
    files are read twice; the ranges' states (one row each) are broadcast up to MAX_RANGES.
    """
    found = chunks(spark, paths)
    states = materialize(entry_states(found.mapInArrow(measure, MEASURED)), "array-ranges")
    check_ends(states)
    if states.limit(MAX_RANGES + 1).count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    states = states.select(*RANGE, "quoted", "depth", "base")
    # The join keeps the order of the chunks, as it moves only the states.
    placed = found.join(F.broadcast(states), RANGE)
    elements = materialize(placed.mapInArrow(cut, ELEMENTS), "array-elements")
    # Every tail begins an element; the pieces behind it, in later ranges, belong to it.
    order = Window.partitionBy("path").orderBy("start", "number")
    pieces = elements.where(F.col("kind") != WHOLE)
    pieces = pieces.withColumn("element", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    in_order = F.array_sort(F.collect_list(F.struct("start", "number", "text")))
    joined = pieces.groupBy("path", "element").agg(
        F.array_join(F.transform(in_order, lambda p: p["text"]), "").alias("text")
    )
    return elements.where(F.col("kind") == WHOLE).select("text").unionByName(joined.select("text"))


def read_json_arrays(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The typed objects of JSON array files. Broken JSON fails the read."""
    parsed = F.from_json("text", schema, {"mode": "FAILFAST"})
    return array_elements(spark, paths).select(parsed.alias("element")).select("element.*")
