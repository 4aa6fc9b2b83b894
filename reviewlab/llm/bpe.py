"""Byte-level BPE over the distinct words of the whole corpus.

Texts are cut into words. Each block of texts keeps the positions of its words as codes into its
own list of distinct words; only those lists are shuffled, dealt by the hash of the word and
packed, so that equal words of all blocks meet. There every distinct word is encoded once. The
ids go back to their blocks, where documents are put together by position, and are decoded by a
join with the token-byte table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import worker_cache
from reviewlab.llm.tokens import text_blocks

#: Bytes of text in a block. Larger blocks repeat fewer words, and need more memory.
BLOCK_BYTES = 16 << 20
#: A blank beside other white space (RE2). Such texts are cut by the pattern itself.
UNEVEN = r" [\s\v\x1c-\x1f\x{85}\p{Z}]|[\s\v\x1c-\x1f\x{85}\p{Z}] "


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def read_ranks(path: str) -> dict[bytes, int]:
    cache = worker_cache()
    if ("ranks", path) not in cache:
        cache["ranks", path] = load_ranks(path)
    return cache["ranks", path]


def cut_words(texts: pa.Array, pattern: str) -> tuple[pa.ListArray, np.ndarray]:
    """(words per text, whether a blank precedes each word).

    Where blanks stand alone, a text can be cut at every blank without cutting any match of the
    pattern, as a match holds a blank only at its start. Other texts are cut into the matches.
    """
    import regex

    lists = pc.split_pattern(texts, " ")
    uneven = np.flatnonzero(pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False))
    if len(uneven):
        compiled = regex.compile(pattern)
        cut = [compiled.findall(texts[int(i)].as_py()) for i in uneven]
        order = np.arange(len(texts))
        order[uneven] = len(texts) + np.arange(len(uneven))
        lists = pa.concat_arrays([lists, pa.array(cut, lists.type)]).take(pa.array(order))
    lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
    blank = np.ones(int(lengths.sum()), bool)
    starts = np.cumsum(lengths) - lengths
    blank[starts[lengths > 0]] = False
    for i in uneven:
        blank[starts[i] : starts[i] + lengths[i]] = False
    return lists, blank


def pack(parts: list[bytes]) -> bytes:
    """Byte strings in one compressed piece: their number, lengths and contents."""
    lengths = np.fromiter(map(len, parts), "<u4", len(parts))
    head = np.array([len(parts)], "<u4").tobytes()
    return zstandard.compress(head + lengths.tobytes() + b"".join(parts), 3)


def unpack(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    stops = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 * (n + 1)
    starts = np.concatenate(([4 * (n + 1)], stops[:-1]))
    return [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


def pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, equal bytes side by side, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


BLOCK = "block long, texts struct<docs:array<long>,lengths:binary,codes:binary,words:binary>"


def word_blocks(docs: DataFrame, pattern: str, text: str) -> DataFrame:
    """Per block its number and texts: documents, words per document, the words as codes, and the
    distinct words, the most frequent first."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, block in enumerate(text_blocks(batches, "text", BLOCK_BYTES)):
            lists, blank = cut_words(block.column("text").fill_null(""), pattern)
            coded = lists.flatten().dictionary_encode()
            keys = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + blank
            counts = np.bincount(keys, minlength=2 * len(coded.dictionary))
            order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
            rank = np.zeros(len(counts), np.int64)
            rank[order] = np.arange(len(order))
            plain = coded.dictionary.take(pa.array(order // 2)).to_pylist()
            words = [(" " + w if odd else w).encode() for w, odd in zip(plain, order % 2)]
            texts = {
                "docs": block.column("doc_id").to_pylist(),
                "lengths": pack_numbers(pc.list_value_length(lists).to_numpy()),
                "codes": pack_numbers(rank[keys]),
                "words": pack(words),
            }
            kind = pa.struct(
                [("docs", pa.list_(pa.int64()))]
                + [(name, pa.binary()) for name in ("lengths", "codes", "words")]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + number], pa.int64()), pa.array([texts], kind)],
                names=["block", "texts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(blocks, BLOCK)


def dealt_words(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, places, words): each block's words by their hash, with their places."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts")):
                words = unpack(texts["words"].as_py())
                part = np.fromiter(
                    (xxhash.xxh32_intdigest(w) % parts for w in words), np.int64, len(words)
                )
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                held = np.flatnonzero(np.diff(edges))
                places = [order[edges[p] : edges[p + 1]] for p in held.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held, pa.int32()),
                        pa.array([block] * len(held), pa.int64()),
                        pa.array([pack_numbers(p) for p in places], pa.binary()),
                        pa.array([pack([words[i] for i in p.tolist()]) for p in places], pa.binary()),
                    ],
                    names=["part", "block", "places", "words"],
                )

    return blocks.mapInArrow(deal, "part int, block long, places binary, words binary")


def encode_words(dealt: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(block, places, ids): each distinct word of a part is encoded once, for all blocks.

    Every match of the pattern in the word is encoded separately.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import tiktoken

        bpe = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )._core_bpe
        matches, piece = regex.compile(pattern).findall, bpe.encode_single_piece
        here, known = None, {}
        for batch in batches:
            found = []
            parts, words = batch.column("part").to_pylist(), batch.column("words").to_pylist()
            for part, packed in zip(parts, words):
                if part != here:
                    here, known = part, {}
                own = unpack(packed)
                for word in own:
                    if word not in known:
                        ids = [i for m in matches(word.decode()) for i in piece(m.encode())]
                        known[word] = np.array(ids, "<u4").tobytes()
                found.append(pack([known[word] for word in own]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("places"), pa.array(found, pa.binary())],
                names=["block", "places", "ids"],
            )

    return dealt.mapInArrow(encode, "block long, places binary, ids binary")


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def assembler(ranks_path: str):
    """The task that puts documents together, decodes them and gives their digests."""

    def token_bytes() -> list[bytes]:
        """The token-byte table by id; as long as the vocabulary, whatever the corpus."""
        cache = worker_cache()
        if ("bytes", ranks_path) not in cache:
            ranks = read_ranks(ranks_path)
            table = [b""] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                table[rank] = token
            cache["bytes", ranks_path] = table
        return cache["bytes", ranks_path]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes()
        names = list(map(str, range(len(table))))
        for batch in batches:
            for texts, found in zip(batch.column("texts"), batch.column("found")):
                codes = unpack_numbers(texts["codes"].as_py())
                n = int(codes.max()) + 1 if len(codes) else 0
                counts, ids, decoded = np.zeros(n, np.int64), [""] * n, [b""] * n
                for part in found:
                    places = unpack_numbers(part["places"].as_py()).tolist()
                    for place, raw in zip(places, unpack(part["ids"].as_py())):
                        own = np.frombuffer(raw, "<u4").tolist()
                        counts[place] = len(own)
                        ids[place] = " ".join([names[i] for i in own])
                        decoded[place] = b"".join([table[i] for i in own])
                stops = np.cumsum(unpack_numbers(texts["lengths"].as_py()).astype(np.int64))
                rows, first = [], 0
                for stop in stops.tolist():
                    own = codes[first:stop]
                    own = own[counts[own] > 0]
                    listed = own.tolist()
                    text = " ".join(map(ids.__getitem__, listed)).encode()
                    raw = b"".join(map(decoded.__getitem__, listed))
                    rows.append(
                        (
                            int(counts[own].sum()),
                            hashlib.sha256(text).hexdigest(),
                            hashlib.sha256(raw).hexdigest(),
                        )
                    )
                    first = stop
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        texts["docs"].values.cast(pa.int64()),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return assemble


def encode_and_decode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by blanks) and
    decoded_sha256 (of the decoded bytes).

    A null text is empty: no tokens. Ids may be null or repeated, rows are never merged. A word
    travels once per block that has it, so no word is hot, however frequent. A block with its
    list of words, at most as long as its text, is the largest thing a task holds. The blocks are
    shuffled once: both uses read the same exchange, so their columns stay together.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = word_blocks(docs, pattern, text).repartition("block")
    dealt = dealt_words(blocks, parts).repartition("part").sortWithinPartitions("part")
    found = (
        encode_words(dealt, ranks_path, pattern)
        .groupBy("block")
        .agg(F.collect_list(F.struct("places", "ids")).alias("found"))
    )
    empty = F.array().cast(found.schema["found"].dataType)
    return (
        blocks.join(found, "block", "left")
        .select("texts", F.coalesce("found", empty).alias("found"))
        .mapInArrow(assembler(ranks_path), RESULT)
    )
