"""Collocations: phrases of two or three words that occur together far more often than apart.

Phrases are grown word by word, the best first. The counts of a prefix and of a suffix bound what
any longer phrase can score: ``xyz`` occurs at most as often as ``xy`` and at least as seldom as
``yz``, so its score is at most f(xy) / f(x), and f(yz) / f(z). Per language a bar is set at the score of
some pair far enough down the list; only triples that can reach the bar, or that hold a pair
that does, are counted. Everything that scores at least the bar is then known, with what drops it.
If fewer than the wanted number survive, the bar is lowered and the frontier expanded.

Every pass over the texts is cut into blocks: a task counts the phrases of a block and sends each
once, and Spark adds the counts up. Which phrases a task has to count it knows from a table of flags by
hash, of a fixed size: a wrong flag only costs a count that is not needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.tokens import text_blocks
from reviewlab.llm.wordscan import byte_classes, scan
from reviewlab.session import materialize

# Fixed values of the contract: what ends a piece, what separates words, and the score's unit.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
UNIT = 1_000_000

LEAST = 10  # times that a phrase must occur
KEEP = 2000  # phrases of each language
ABSORBED = 50  # percent of a phrase's occurrences inside one longer candidate that drop it

#: Bytes of text that a task counts together.
BLOCK_BYTES = 4 << 20
#: Rows that a task sends at once.
BATCH_ROWS = 1 << 16
#: The flag table has 2 ** FLAG_BITS bytes whatever the corpus holds.
FLAG_BITS = 24
#: Rank among the pairs where the bar is set, by round; behind the last round it is zero.
BAR_RANKS = (2 * KEEP, 16 * KEEP)
#: Parts that a language's ranking is dealt to.
PARTS = 64

# Flags of words and pairs.
FREQUENT, PREFIX, SUFFIX, HOLDS = 1, 2, 4, 8
FLAGS = "chunk int, flags binary"
CHUNK_BITS = 16


def hashes(words: pa.Array, lang: str) -> np.ndarray:
    """64-bit hashes of words, one language's apart from another's."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    digest = xxhash.xxh3_64_intdigest
    keys = (digest(word, seed) for word in words.cast(pa.binary()).to_pylist())
    return np.fromiter(keys, np.uint64, len(words))


def place(*parts: np.ndarray) -> np.ndarray:
    """Place in the flag table of words or pairs, from the hashes of their words."""
    mixed = parts[0]
    for part in parts[1:]:
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (part >> np.uint64(7)) ^ part
    mixed = mixed * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - FLAG_BITS)).astype(np.int64)


def flag_table(rows: DataFrame, words: list[str]) -> Broadcast:
    """Flags by hash of ``lang`` and ``words``: a table of fixed size, put together in chunks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FLAG_BITS, np.uint8)
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            of = langs.indices.to_numpy(zero_copy_only=False)
            flags = batch.column("flags").to_numpy(zero_copy_only=False).astype(np.uint8)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(of == code)
                keys = [hashes(batch.column(w).take(pa.array(mine)), lang) for w in words]
                np.bitwise_or.at(table, place(*keys), flags[mine])
        pieces = table.reshape(-1, 1 << min(CHUNK_BITS, FLAG_BITS))
        filled = np.flatnonzero(pieces.any(axis=1))
        yield pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array(filled, pa.int32()),
                "flags": pa.array([pieces[i].tobytes() for i in filled], pa.binary()),
            }
        )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, flags in zip(*[c.to_pylist() for c in batch.columns]):
                known = held.setdefault(chunk, np.zeros(len(flags), np.uint8))
                known |= np.frombuffer(flags, np.uint8)
        rows = [{"chunk": c, "flags": f.tobytes()} for c, f in held.items()]
        schema = pa.schema([("chunk", pa.int32()), ("flags", pa.binary())])
        yield pa.RecordBatch.from_pylist(rows, schema)

    spread = rows.select("lang", *words, "flags").mapInArrow(partial, FLAGS)
    chunks = spread.repartition("chunk").mapInArrow(merged, FLAGS)
    table = np.zeros(1 << FLAG_BITS, np.uint8).reshape(-1, 1 << min(CHUNK_BITS, FLAG_BITS))
    # At most 2 ** FLAG_BITS bytes, whatever the number of rows.
    for row in chunks.toLocalIterator():
        table[row["chunk"]] = np.frombuffer(row["flags"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(zstandard.compress(table.tobytes(), 1))


def flags_of(table: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(table), np.uint8)


def texts_by_language(block: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs = block.column("lang").dictionary_encode()
    of = langs.indices.to_numpy(zero_copy_only=False)
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, block.column("text").take(pa.array(np.flatnonzero(of == code)))


def counted(codes: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of codes below ``size`` and how often each occurs."""
    mixed = codes[0]
    for column in codes[1:]:
        # Numbered anew after each column, products stay below 2 ** 63.
        _, mixed = np.unique(mixed, return_inverse=True)
        mixed = mixed.astype(np.int64) * size + column
    _, first, counts = np.unique(mixed, return_index=True, return_counts=True)
    return [column[first] for column in codes], counts


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, w1, f`` of every word; a null word has the number of all words."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes(BLANKS, BREAKS)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            for lang, texts in texts_by_language(block):
                words = scan(texts, classes)
                counts = np.bincount(words.codes, minlength=len(words.distinct))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * (len(counts) + 1), pa.string()),
                        "w1": pa.concat_arrays([words.distinct, pa.nulls(1, pa.string())]),
                        "n": pa.array(np.append(counts, len(words.codes)), pa.int64()),
                    }
                )

    parts = docs.mapInArrow(blocks, "lang string, w1 string, n long")
    return parts.groupBy("lang", "w1").agg(F.sum("n").alias("f"))


def count_phrases(docs: DataFrame, length: int, flags: Broadcast) -> DataFrame:
    """``lang, w1, ..., f`` of phrases of two words that are both flagged, or of three whose two
    pairs are flagged together as ``wanted`` says; those that occur LEAST times."""
    names = [f"w{i + 1}" for i in range(length)]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes(BLANKS, BREAKS)
        table = flags_of(flags.value)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            for lang, texts in texts_by_language(block):
                words = scan(texts, classes)
                keys = hashes(words.distinct, lang)
                same = (words.text[1:] == words.text[:-1]) & (words.piece[1:] == words.piece[:-1])
                if length == 2:
                    often = (table[place(keys)] != 0)[words.codes]
                    kept = np.flatnonzero(same & often[1:] & often[:-1])
                else:
                    pairs = np.flatnonzero(same)
                    marks = np.zeros(len(same), np.uint8)
                    first, second = keys[words.codes[pairs]], keys[words.codes[pairs + 1]]
                    marks[pairs] = table[place(first, second)]
                    kept = np.flatnonzero(wanted(marks[:-1], marks[1:]))
                columns = [words.codes[kept + i] for i in range(length)]
                columns, counts = counted(columns, len(words.distinct) + 1)
                filled = {
                    name: words.distinct.take(pa.array(column))
                    for name, column in zip(names, columns)
                }
                langs = pa.array([lang] * len(counts), pa.string())
                batch = pa.RecordBatch.from_pydict(
                    {"lang": langs} | filled | {"n": pa.array(counts, pa.int64())}
                )
                for start in range(0, len(counts), BATCH_ROWS):
                    yield batch.slice(start, BATCH_ROWS)
                del words, keys, columns, filled, langs, batch
            pa.default_memory_pool().release_unused()

    schema = ", ".join(["lang string", *[f"{name} string" for name in names], "n long"])
    parts = docs.mapInArrow(blocks, schema)
    return parts.groupBy("lang", *names).agg(F.sum("n").alias("f")).where(F.col("f") >= LEAST)


def wanted(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a triple is counted, from the flags of its two pairs (none: not frequent)."""
    both = (left & right & FREQUENT) != 0
    reach = ((left & PREFIX) != 0) & ((right & SUFFIX) != 0)
    return both & (reach | (((left | right) & HOLDS) != 0))


def score(whole: str, left: str, right: str) -> Column:
    """floor(UNIT * whole * whole / (left * right)), exact for counts below 10 ** 14."""
    product = f"cast({left} as decimal(14,0)) * cast({right} as decimal(14,0))"
    square = f"cast({whole} as decimal(14,0)) * cast({whole} as decimal(14,0))"
    return F.expr(f"cast(({square} * cast({UNIT} as decimal(7,0))) div ({product}) as long)")


def ranked(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows of every language with their rank, cut in parts before they meet."""
    part = F.abs(F.xxhash64("phrase")) % PARTS
    inside = Window.partitionBy("lang", "part").orderBy(*order)
    first = rows.withColumn("part", part).withColumn("rank", F.row_number().over(inside))
    first = first.where(F.col("rank") <= most).drop("rank", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return first.withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)


def score_at_rank(scores: DataFrame, rank: int) -> DataFrame:
    """``lang, bar``: the score at a rank, or zero where there are fewer rows. A language has at
    most UNIT + 1 different scores, so it is found by counting those."""
    steps = scores.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("lang").orderBy(F.desc("score"))
    steps = steps.withColumn("at", F.sum("n").over(down))
    bar = F.max(F.when(F.col("at") >= rank, F.col("score")))
    return steps.groupBy("lang").agg(F.coalesce(bar, F.lit(0)).alias("bar"))


def pair_table(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, w1, w2, a, l, r, score`` of the frequent pairs."""
    flagged = words.withColumn("flags", F.lit(FREQUENT))
    pairs = count_phrases(docs, 2, flag_table(flagged, ["w1"])).withColumnRenamed("f", "a")
    left = words.withColumnRenamed("f", "l")
    right = words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r"))
    joined = pairs.join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
    return joined.withColumn("score", score("a", "l", "r"))


def triple_table(docs: DataFrame, pairs: DataFrame, bars: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, a, l, r, score`` of frequent triples that can reach their language's bar
    or hold a pair that does; others may be among them."""
    bar = F.col("bar")
    flags = (
        F.lit(FREQUENT)
        + F.when(UNIT * F.col("a") >= bar * F.col("l"), PREFIX).otherwise(0)
        + F.when(UNIT * F.col("a") >= bar * F.col("r"), SUFFIX).otherwise(0)
        + F.when(F.col("score") >= bar, HOLDS).otherwise(0)
    )
    # Languages without a bar are settled: nothing of theirs is flagged.
    flagged = pairs.join(bars, "lang").withColumn("flags", flags)
    counts = count_phrases(docs, 3, flag_table(flagged, ["w1", "w2"]))
    first = pairs.select("lang", "w1", "w2", F.col("a").alias("f12"), F.col("l").alias("f1"))
    second = pairs.select(
        "lang",
        F.col("w1").alias("w2"),
        F.col("w2").alias("w3"),
        F.col("a").alias("f23"),
        F.col("r").alias("f3"),
    )
    counts = counts.withColumnRenamed("f", "a")
    joined = counts.join(first, ["lang", "w1", "w2"]).join(second, ["lang", "w2", "w3"])
    joined = joined.withColumn("s1", score("a", "f1", "f23"))
    joined = joined.withColumn("s2", score("a", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    return joined.select(
        "lang",
        "w1",
        "w2",
        "w3",
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )


def survivors(pairs: DataFrame, triples: DataFrame, bars: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of what reaches the bar and lies in no longer candidate that
    has ABSORBED percent of its occurrences. Those of a triple count for both of its pairs."""
    inside = triples.select("lang", "w1", "w2", F.col("a").alias("most")).unionByName(
        triples.select(
            "lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("most")
        )
    )
    inside = inside.groupBy("lang", "w1", "w2").agg(F.max("most").alias("most"))
    reach = pairs.join(bars, "lang").where("score >= bar").join(inside, ["lang", "w1", "w2"], "left")
    free = F.col("most").isNull() | (100 * F.col("most") < ABSORBED * F.col("a"))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    kept = reach.where(free).withColumn("phrase", F.concat_ws(" ", "w1", "w2")).select(*columns)
    threes = triples.join(bars, "lang").where("score >= bar")
    threes = threes.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")).select(*columns)
    return kept.unionByName(threes)


def collocations(docs: DataFrame) -> DataFrame:
    """The first KEEP phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` holds text (null: empty) and lang (null: ``und``); other columns are ignored. Rows are
    ranked by score and a, falling, then by phrase. Languages without a frequent phrase have no
    row. A text of any length is counted in one block.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = count_words(texts).where(F.col("w1").isNull() | (F.col("f") >= LEAST))
    counts = materialize(counts, "phrase-words")
    sizes = counts.where("w1 is null").select("lang", F.col("f").alias("n"))
    words = counts.where("w1 is not null")
    pairs = materialize(pair_table(texts, words), "phrase-pairs")
    done = None
    open_langs = pairs.select("lang").distinct()
    for rank in (*BAR_RANKS, None):
        if rank is None:
            bars = open_langs.withColumn("bar", F.lit(0).cast("long"))
        else:
            bars = score_at_rank(pairs.join(open_langs, "lang"), rank)
        bars = materialize(bars, "phrase-bars")
        triples = materialize(triple_table(texts, pairs, bars), "phrase-triples")
        found = materialize(survivors(pairs, triples, bars), "phrases")
        enough = found.groupBy("lang").count().where(F.col("count") >= KEEP)
        settled = bars.where("bar = 0").select("lang").union(enough.select("lang")).distinct()
        part = found.join(settled, "lang", "left_semi")
        done = part if done is None else done.unionByName(part)
        open_langs = materialize(bars.select("lang").join(settled, "lang", "left_anti"), "open")
        if open_langs.isEmpty():
            break
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    numbers = ["a", "l", "r", "n", "score"]
    best = ranked(done, order, KEEP).join(sizes, "lang")
    return best.select("lang", "rank", "phrase", *[F.col(c).cast("long") for c in numbers])
