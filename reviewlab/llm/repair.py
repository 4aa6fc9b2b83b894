"""Token files compressed by a Re-Pair grammar.

Every block of documents has a grammar of its own: frequent pairs of neighbouring ids are
replaced by new symbols, again and again. The file holds the rules, how many ids each new symbol
stands for, the remaining symbols, and where each document begins, so one document can be decoded
without its neighbours.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlab.llm.tokens import text_blocks, with_special
from reviewlab.session import scratch_path

#: The id behind every document; no rule contains it, so rules never span two documents.
END = 1
#: New symbols start here; symbols are written as 16 bits.
FIRST_SYMBOL = 49_408
LAST_SYMBOL = 65_535
#: Rounds of replacement, rules found per round, and times that a pair must occur.
ROUNDS = 3
RULES_PER_ROUND = 5_000
MIN_COUNT = 16

MAGIC = b"RPG1"
HEADER = "<4sIIIQ"
BUCKET_BITS = 20
MIX = np.uint32(0x9E3779B1)


@dataclass
class Grammar:
    """Symbols, rules (left, right), the rounds' first symbols, and per document how many symbols
    and ids it has."""

    symbols: np.ndarray
    left: np.ndarray
    right: np.ndarray
    rounds: list[int]
    doc_symbols: np.ndarray
    doc_ids: np.ndarray


def frequent_pairs(keys: np.ndarray, most: int) -> np.ndarray:
    """The most frequent keys that occur at least MIN_COUNT times, the most frequent first."""
    ordered = np.sort(keys)
    edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(edges, len(ordered)))
    often = np.flatnonzero(counts >= MIN_COUNT)
    best = often[np.argsort(-counts[often], kind="stable")[:most]]
    return ordered[edges[best]]


def replace_pairs(
    symbols: np.ndarray, keys: np.ndarray, chosen: np.ndarray, first: int
) -> np.ndarray:
    """Replace every chosen pair, from the left and without overlap, by its new symbol.

    ``keys`` are the symbols' own pairs.
    """
    bucket = np.zeros(1 << BUCKET_BITS, np.int32)
    place = lambda k: (k * MIX) >> np.uint32(32 - BUCKET_BITS)
    # Of two pairs in one bucket the more frequent one is written last and stays.
    bucket[place(chosen[::-1])] = np.arange(len(chosen), dtype=np.int32)[::-1]
    candidate = bucket[place(keys)]
    at = np.flatnonzero(chosen[candidate] == keys)
    if not len(at):
        return symbols
    run = np.maximum.accumulate(
        np.where(np.diff(at, prepend=at[0] - 2) > 1, np.arange(len(at)), 0)
    )
    at = at[(np.arange(len(at)) - run) % 2 == 0]
    out = symbols.copy()
    out[at] = first + candidate[at]
    stays = np.ones(len(out), bool)
    stays[at + 1] = False
    return out[stays]


def pair_keys(symbols: np.ndarray) -> np.ndarray:
    wide = symbols.astype(np.uint32)
    return (wide[:-1] << np.uint32(16)) | wide[1:]


def compress(ids: np.ndarray, doc_ids: np.ndarray) -> Grammar:
    """The grammar of the ids of some documents, each ending with END."""
    symbols = ids.astype(np.uint16)
    left, right, rounds = [], [], []
    first = FIRST_SYMBOL
    for _ in range(ROUNDS):
        room = LAST_SYMBOL + 1 - first
        keys = pair_keys(symbols)
        ends = symbols == END
        inside = keys[~(ends[:-1] | ends[1:])]
        chosen = frequent_pairs(inside, min(room, RULES_PER_ROUND)) if room else inside[:0]
        if not len(chosen):
            break
        symbols = replace_pairs(symbols, keys, chosen, first)
        left.append((chosen >> np.uint32(16)).astype(np.uint16))
        right.append((chosen & np.uint32(0xFFFF)).astype(np.uint16))
        rounds.append(first)
        first += len(chosen)
    none = np.zeros(0, np.uint16)
    grammar = Grammar(
        symbols,
        np.concatenate(left or [none]),
        np.concatenate(right or [none]),
        rounds,
        none,
        doc_ids,
    )
    # A document ends with a symbol of its own, as END is in no rule (but may be in a text).
    widths = np.concatenate((np.ones(FIRST_SYMBOL, np.uint32), expansion_lengths(grammar)))
    ends = np.searchsorted(np.cumsum(widths[symbols], dtype=np.int64), np.cumsum(doc_ids))
    grammar.doc_symbols = np.diff(ends, prepend=-1)
    return grammar


def expand(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for; the rules of the last round are undone first."""
    for first in reversed(grammar.rounds):
        new = symbols >= first
        width = new.astype(np.int64) + 1
        at = np.cumsum(width) - width
        out = np.repeat(symbols, width)
        rule = symbols[new].astype(np.int64) - FIRST_SYMBOL
        out[at[new]] = grammar.left[rule]
        out[at[new] + 1] = grammar.right[rule]
        symbols = out
    return symbols


def expansion_lengths(grammar: Grammar) -> np.ndarray:
    """How many ids each new symbol stands for."""
    lengths = np.ones(LAST_SYMBOL + 1, np.uint32)
    stops = [*grammar.rounds[1:], FIRST_SYMBOL + len(grammar.left)]
    for first, stop in zip(grammar.rounds, stops):
        rule = slice(first - FIRST_SYMBOL, stop - FIRST_SYMBOL)
        lengths[first:stop] = lengths[grammar.left[rule]] + lengths[grammar.right[rule]]
    return lengths[FIRST_SYMBOL : FIRST_SYMBOL + len(grammar.left)]


def to_bytes(grammar: Grammar) -> bytes:
    """Header (magic, rounds, rules, documents, symbols) and the arrays, little-endian."""
    head = struct.pack(
        HEADER,
        MAGIC, len(grammar.rounds), len(grammar.left), len(grammar.doc_ids), len(grammar.symbols)
    )
    parts = (
        (grammar.rounds, "<u4"),
        (grammar.left, "<u2"),
        (grammar.right, "<u2"),
        (expansion_lengths(grammar), "<u4"),
        (grammar.doc_symbols, "<u4"),
        (grammar.doc_ids, "<u4"),
        (grammar.symbols, "<u2"),
    )
    return head + b"".join(np.asarray(part).astype(kind).tobytes() for part, kind in parts)


def from_bytes(data: bytes) -> Grammar:
    magic, rounds, rules, docs, symbols = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("no token file of this kind")
    at, parts = struct.calcsize(HEADER), []
    for kind, n in (
        ("<u4", rounds),
        ("<u2", rules),
        ("<u2", rules),
        ("<u4", rules),
        ("<u4", docs),
        ("<u4", docs),
        ("<u2", symbols),
    ):
        part = np.frombuffer(data, kind, n, at)
        at += part.nbytes
        parts.append(part)
    first, left, right, _, doc_symbols, doc_ids, rest = parts
    return Grammar(rest, left, right, [int(x) for x in first], doc_symbols, doc_ids)


def decode_document(grammar: Grammar, n: int) -> np.ndarray:
    """The ids of the n-th document alone."""
    stop = int(grammar.doc_symbols[: n + 1].sum())
    return expand(grammar, grammar.symbols[stop - int(grammar.doc_symbols[n]) : stop])


BLOCKS = "block long, docs array<long>, n_tokens long, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, text: str = "text") -> None:
    """Write the token files of all documents below ``path``, in ascending doc_id order.

    A row (shard, block, docs, n_tokens, data) is one compressed block; shards are ranges of
    doc_id, blocks are numbered in each. Null ids come first, rows with the same id are all
    written, a null text is empty (only the end id). A task holds one block at a time.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in enumerate(text_blocks(batches, "text")):
            ids, lengths = with_special(block.column("text"), tokenizer, END)
            data = to_bytes(compress(ids, lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([data], pa.binary()),
                ],
                names=["block", "docs", "n_tokens", "data"],
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
    )
    ordered.mapInArrow(blocks, BLOCKS).select(
        F.spark_partition_id().alias("shard"), "*"
    ).write.parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, start): ids before each block. First summed per shard, then inside each."""
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return blocks.select(
        "shard", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inner")
    ).join(shards, "shard").select("shard", "block", (F.col("offset") + F.col("inner")).alias("start"))


def read_tokens(blocks: DataFrame) -> DataFrame:
    """Per document of token files: doc_id, start, n_tokens, ids_crc32."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                grammar = from_bytes(batch.column("data")[row].as_py())
                ids = memoryview(expand(grammar, grammar.symbols).astype("<u4"))
                stops = np.cumsum(grammar.doc_ids.astype(np.int64))
                starts = stops - grammar.doc_ids
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("docs")[row].values.cast(pa.int64()),
                        pa.array(starts + batch.column("start")[row].as_py(), pa.int64()),
                        pa.array(grammar.doc_ids, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    starts = block_starts(blocks.select("shard", "block", "n_tokens"))
    placed = blocks.join(starts, ["shard", "block"]).select("docs", "data", "start")
    return placed.mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def stored_tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Write the token files to the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_tokens(docs, path, tokenizer, text)
    return read_tokens(spark.read.parquet(path))
