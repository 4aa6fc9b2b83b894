"""Token counts of documents in flat token files that have no index.

A flat file is a stream of 16-bit ids in which an end id follows every document. It is read in
blocks that cut documents anywhere. Each block is searched on its own; a prefix scan over the
blocks then tells where the document that is open at a block's border began.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlab.llm.tokens import encode_texts, text_blocks
from reviewlab.session import materialize, scratch_path

#: Ids in a block of a flat file.
BLOCK_IDS = 1 << 20
#: Blocks that are scanned together before their sums are.
GROUP = 1024

FLAT = "block long, tokens binary"


def flat_files(docs: DataFrame, tokenizer: str, end: int, text: str = "text") -> DataFrame:
    """Flat token files of all documents: (file, block, tokens), stored in the shared folder.

    Each task writes the documents it reads, in their order, as one file; texts are not shuffled.
    No document begins where a block does but by chance. A null text is empty.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rest = 0, np.zeros(0, np.uint16)
        for block in text_blocks(batches, "text"):
            ids, _ = encode_texts(block.column("text"), tokenizer, end)
            rest = np.concatenate((rest, ids))
            while len(rest) >= BLOCK_IDS:
                yield flat_block(number, rest[:BLOCK_IDS])
                number, rest = number + 1, rest[BLOCK_IDS:]
        if len(rest):
            yield flat_block(number, rest)

    spark = docs.sparkSession
    path = scratch_path(spark, "flat-tokens")
    flat = docs.select(F.col(text).alias("text")).mapInArrow(blocks, FLAT)
    flat.select(F.spark_partition_id().cast("long").alias("file"), "*").write.option(
        "compression", "zstd"
    ).parquet(path)
    return spark.read.parquet(path)


def flat_block(number: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([ids.astype("<u2").tobytes()], pa.binary())],
        names=["block", "tokens"],
    )


def find_ends(files: DataFrame, end: int) -> DataFrame:
    """Per block: file, block, n (ids), ends (places of the end id in the block)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column("tokens")[row].as_buffer()
                ids = np.frombuffer(data, "<u2") if data is not None else np.zeros(0, "<u2")
                ends = np.flatnonzero(ids == end)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("file").slice(row, 1),
                        batch.column("block").slice(row, 1),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["file", "block", "n", "ends"],
                )

    return files.mapInArrow(search, "file long, block long, n long, ends array<long>")


def running(value: Column, window: Window) -> Column:
    return F.coalesce(value.over(window), F.lit(0).cast("long"))


def prefix_scan(blocks: DataFrame) -> DataFrame:
    """Per block (file, block, n, found, last): ids, ends and the open document's start before it.

    ``last`` is the place behind the last end in the block, counted from the block's start, null
    without one. The scan has two levels, groups of blocks and then the blocks of each group, so
    no task sees more than GROUP blocks or the sums of the groups of one file.
    """
    blocks = blocks.withColumn("group", F.expr(f"block div {GROUP}"))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(*earlier)
    local = blocks.withColumn("base", running(F.sum("n"), inside))
    local = local.withColumn("seen", running(F.sum("found"), inside))
    local = local.withColumn("open", F.max(F.col("base") + F.col("last")).over(inside))
    groups = local.groupBy("file", "group").agg(
        F.sum("n").alias("n"),
        F.sum("found").alias("found"),
        F.max(F.col("base") + F.col("last")).alias("last"),
    )
    over = Window.partitionBy("file").orderBy("group").rowsBetween(*earlier)
    groups = groups.withColumn("group_base", running(F.sum("n"), over))
    groups = groups.withColumn("group_seen", running(F.sum("found"), over))
    groups = groups.withColumn("group_open", running(F.max(F.col("group_base") + F.col("last")), over))
    return local.join(
        groups.select("file", "group", "group_base", "group_seen", "group_open"), ["file", "group"]
    ).select(
        "file",
        "block",
        (F.col("group_base") + F.col("base")).alias("base"),
        (F.col("group_seen") + F.col("seen")).alias("seen"),
        F.coalesce(F.col("group_base") + F.col("open"), F.col("group_open")).alias("open"),
    )


def count_tokens(files: DataFrame, end: int) -> DataFrame:
    """Per document: file, doc_no, start, n_tokens (with the end id), terminated.

    ``files`` has file, block and tokens (little-endian 16-bit ids); doc_no and start count from
    the beginning of the file. Ids behind the last end id are one more document that is not
    terminated. Blocks that are null or empty hold no ids; block numbers need not be dense.
    """
    ends = materialize(find_ends(files, end), "token-ends")
    summary = ends.select(
        "file",
        "block",
        "n",
        F.size("ends").cast("long").alias("found"),
        F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1).alias("last"),
    )
    scanned = materialize(prefix_scan(summary), "token-scan")
    placed = ends.join(scanned, ["file", "block"])
    each = placed.select("file", "base", "seen", "open", "ends", F.posexplode("ends"))
    before = F.when(
        F.col("pos") > 0, F.col("base") + F.get("ends", F.col("pos") - 1) + 1
    ).otherwise(F.col("open"))
    done = each.select(
        "file",
        (F.col("seen") + F.col("pos")).alias("doc_no"),
        before.alias("start"),
        (F.col("base") + F.col("col") + 1 - before).alias("n_tokens"),
        F.lit(True).alias("terminated"),
    )
    whole = (
        placed.withColumn(
            "behind",
            F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1) + 1),
        )
        .groupBy("file")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.size("ends")).alias("doc_no"),
            F.coalesce(F.max("behind"), F.lit(0).cast("long")).alias("start"),
        )
    )
    open_end = whole.where("n > start").select(
        "file", "doc_no", "start", (F.col("n") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("terminated"),
    )
    return done.unionByName(open_end)
