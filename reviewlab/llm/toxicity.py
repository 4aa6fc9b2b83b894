"""Toxicity of texts written to be misread: letters swapped for digits and signs, letters set
apart, letters repeated.

A noisy channel restores such words first. Every odd-looking form is a lattice: each sign may be
itself or the letters it stands for, a run of one letter may be one letter or two, and signs
between letters may be left out. The likeliest path under a character language model, counted over
all texts of the corpus, is the restored word (Viterbi). Restored texts are then scored by logistic
regression over parts of words that toxic texts have more often than others.

Defined results: null and empty texts get a score like any other (no part is found); rows keep
their number, also repeated ones; no document of a language or source is treated apart. Without
labels of both kinds every score is the share of toxic labels (0.5 without any).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import SPACE, worker_cache
from reviewlab.llm.tokens import text_blocks
from reviewlab.llm.wordscan import Words, byte_classes, scan
from reviewlab.session import materialize

#: Bytes of text that a task works on together.
BLOCK_BYTES = 4 << 20
TRAINING_BYTES = 1 << 20
#: Labelled rows that the classifier is fitted on (those with the least hash), and parts of words.
MAX_LABELLED = 20_000
MAX_PARTS = 2_000
#: Training documents that must hold a part, and how surely it must be more frequent in toxic ones.
MIN_DOCS, MIN_Z = 8, 4.0
PART_LENGTHS = (3, 4, 5)
#: Restored forms that a worker keeps.
CACHE_WORDS = 300_000

# The language model: counts of four letters in a row. Letters beyond a to z are one class; class 0
# is the border of a word.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES = len(LETTERS) + 2
OTHER = CLASSES - 1
ORDER = 4

# What signs stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e",
    "£": "l", "*": LETTERS, "#": LETTERS,
}
#: Costs (negative logs) of the channel.
SWAP, WILD, SKIP, EDGE, DROP, REPEAT, UNDOUBLE = 1.0, 3.0, 1.5, 0.75, 2.0, 1.0, 4.0

EDGES = "\"'`.,;:?!()[]{}<>-_~/\\|*#%&=+^"


def letter_class(char: str) -> int:
    place = ord(char) - 97
    return place + 1 if 0 <= place < 26 else OTHER


def class_counts(words: pa.Array, counts: np.ndarray) -> np.ndarray:
    """How often each ORDER classes in a row occur in words, which count as often as said."""
    table = np.zeros(CLASSES**ORDER, np.int64)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # All words side by side, each with ORDER - 1 borders before it and one behind.
    text = "".join(words.to_pylist())
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64) - 96
    codes[(codes < 1) | (codes > 26)] = OTHER
    padded = np.zeros(len(codes) + ORDER * len(lengths), np.int64)
    ends = np.cumsum(lengths + ORDER)
    starts = ends - lengths - 1
    inner = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(codes))
    padded[inner] = codes
    key = np.zeros(len(padded) - ORDER + 1 if len(padded) else 0, np.int64)
    for i in range(ORDER):
        key = key * CLASSES + padded[i : i + len(key)]
    # A window belongs to the word of its last letter.
    owner = np.repeat(np.arange(len(lengths)), lengths + ORDER)[ORDER - 1 :]
    real = np.flatnonzero((key % CLASSES != 0) | (key // CLASSES % CLASSES != 0))
    np.add.at(table, key[real], counts[owner[real]])
    return table


def language_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative logs) of a letter class behind three others, from the words of all texts.

    The counts are at most CLASSES ** ORDER numbers, however large the corpus is.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes(SPACE.encode())
        total = np.zeros(CLASSES**ORDER, np.int64)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            words = scan(block.column("text"), classes)
            counts = np.bincount(words.codes, minlength=len(words.distinct))
            low = pc.utf8_trim(pc.utf8_lower(words.distinct), EDGES)
            plain = pc.utf8_is_alpha(low).to_numpy(zero_copy_only=False)
            total += class_counts(low.filter(pa.array(plain)), counts[plain])
        key = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"key": pa.array(key), "n": pa.array(total[key])})

    rows = docs.select("text").mapInArrow(blocks, "key long, n long")
    sums = rows.groupBy("key").agg(F.sum("n").alias("n"))
    table = np.zeros(CLASSES**ORDER)
    for row in sums.toLocalIterator():
        table[row["key"]] = row["n"]
    return model_costs(table)


def model_costs(table: np.ndarray) -> np.ndarray:
    """Witten-Bell: a context gives the next shorter one as much as it has different followers."""
    table = table.reshape((CLASSES,) * ORDER)
    share = np.full(CLASSES, 1 / CLASSES)
    for order in range(1, ORDER + 1):
        counts = table.sum(axis=tuple(range(ORDER - order)))
        kinds = (counts > 0).sum(axis=-1, keepdims=True)
        total = counts.sum(axis=-1, keepdims=True)
        share = (counts + kinds * share) / np.maximum(total + kinds, 1)
        share = np.where(total + kinds > 0, share, 1 / CLASSES)
    return -np.log(share)


def arcs(form: str) -> list[list[tuple[int, str, float]]]:
    """The lattice of a form: per place (next place, letters, cost)."""
    out: list[list[tuple[int, str, float]]] = []
    place = 0
    while place < len(form):
        char = form[place]
        end = place
        while end < len(form) and form[end] == char:
            end += 1
        length = end - place
        if char.isalpha():
            here = [(end, char, [0, 0, UNDOUBLE, REPEAT][min(length, 3)])]
            if length > 1:
                here.append((end, char * 2, REPEAT * (length > 2)))
        else:
            swapped = LEET.get(char, "")
            cost = WILD if len(swapped) > 2 else SWAP
            here = [(end, s, cost + REPEAT * (length > 1)) for s in swapped]
            if 1 < length and len(swapped) <= 2:
                here += [(end, s * 2, cost) for s in swapped]
            inner = 0 < place and end < len(form)
            here.append((end, "", (SKIP if inner else EDGE) + (DROP if swapped else 0)))
        out += [here] + [[] for _ in range(length - 1)]
        place = end
    return out


def restore(form: str, costs: list) -> str:
    """The likeliest word behind a form; the form itself if that is likelier still."""
    lattice = arcs(form)
    # Per place: the last three classes -> (cost, letters as a chain of what was added, which long
    # forms share). A place that was left is empty again.
    best: list[dict[tuple[int, int, int], tuple[float, tuple]]] = [{} for _ in range(len(form) + 1)]
    best[0][0, 0, 0] = (0.0, ())
    for place, arc in enumerate(lattice):
        here, best[place] = best[place], {}
        for context, (cost, letters) in here.items():
            for end, added, price in arc:
                total, now = cost + price, context
                for char in added:
                    code = letter_class(char)
                    total += costs[now[0]][now[1]][now[2]][code]
                    now = (now[1], now[2], code)
                known = best[end].get(now)
                chain = (letters, added) if added else letters
                if known is None or total < known[0] or (
                    total == known[0] and spelled(chain) < spelled(known[1])
                ):
                    best[end][now] = (total, chain)
    ends = [
        (cost + costs[a][b][c][0], letters)
        for (a, b, c), (cost, letters) in best[-1].items()
        if letters
    ]
    if not ends:
        return form
    least = min(cost for cost, _ in ends)
    return min(spelled(letters) for cost, letters in ends if cost == least)


def spelled(chain: tuple) -> str:
    parts = []
    while chain:
        chain, added = chain
        parts.append(added)
    return "".join(reversed(parts))


class Restorer:
    """Restored words, kept by form."""

    def __init__(self, costs: np.ndarray):
        self.table = costs.tolist()
        self.kept: dict[str, str] = {}

    def word(self, form: str) -> str:
        if (known := self.kept.get(form)) is None:
            if len(self.kept) >= CACHE_WORDS:
                self.kept.clear()
            known = self.kept[form] = restore(form, self.table)
        return known

    def words(self, forms: pa.Array) -> list[str]:
        """One word for each form: lowered, without signs around it, restored if it looks odd."""
        low = pc.utf8_lower(forms)
        bare = pc.utf8_trim(low, EDGES)
        plain = pc.and_(
            pc.utf8_is_alpha(bare), pc.invert(pc.match_substring_regex(bare, TRIPLE))
        ).to_numpy(zero_copy_only=False)
        out = bare.to_pylist()
        odd = np.flatnonzero(~plain)
        whole = low.take(pa.array(odd)).to_pylist()
        for i, form in zip(odd.tolist(), whole):
            out[i] = self.odd(form, out[i])
        return out

    def odd(self, form: str, bare: str) -> str:
        letters = sum(c.isalpha() for c in form)
        if not letters or 5 * letters < 2 * len(bare):
            return bare
        form = TAIL.sub("", form.strip(QUOTES))
        return self.word(form) if not form.isalpha() or THRICE.search(form) else form


THRICE = re.compile(r"(.)\1\1")
# RE2 has no back references: runs of three equal letters a to z.
TRIPLE = "|".join(c * 3 for c in LETTERS)
QUOTES = "\"'`()[]{}<>"
#: Signs behind a word; a dollar or two may be letters.
TAIL = re.compile(r"(?:[.,;:?!%&=^~#*\-_+|]|\${3,})+$")


def spaced_runs(words: Words) -> list[tuple[int, int]]:
    """Runs of three or more words of one character in a text, as (first, behind the last)."""
    single = pc.equal(pc.utf8_length(words.distinct), 1).to_numpy(zero_copy_only=False)
    one = single[words.codes] if len(words.codes) else np.zeros(0, bool)
    starts = one.copy()
    starts[1:] &= ~(one[:-1] & (words.text[1:] == words.text[:-1]))
    first = np.flatnonzero(starts)
    if not len(first):
        return []
    stop = ~one
    change = np.append(stop[1:] | (words.text[1:] != words.text[:-1]), True)
    last = np.flatnonzero(one & change)
    long = last - first >= 2
    return list(zip(first[long].tolist(), (last[long] + 1).tolist()))


@dataclass
class Restored:
    """Texts as codes into restored words."""

    codes: np.ndarray
    text: np.ndarray
    words: list[str]


def restored_words(texts: pa.Array, restorer: Restorer) -> Restored:
    """Words of every text; a run of single characters is joined to one form first."""
    words = scan(texts, byte_classes(SPACE.encode()))
    known = restorer.words(words.distinct)
    codes, owner = words.codes, words.text
    runs = spaced_runs(words)
    if runs:
        forms = words.distinct.to_pylist()
        keep = np.ones(len(codes), bool)
        codes = codes.copy()
        joined: dict[str, int] = {}
        for first, end in runs:
            parts = [forms[c] for c in codes[first:end].tolist()]
            form = "".join(parts)
            if len(set(form)) < 3:
                continue
            if form not in joined:
                joined[form] = len(known)
                known = [*known, restorer.odd(form, form)]
            codes[first] = joined[form]
            keep[first + 1 : end] = False
        codes, owner = codes[keep], owner[keep]
    return Restored(codes, owner, known)


def word_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the parts of all words, one word after the other; parts per word).

    Parts are PART_LENGTHS characters in a row, the borders of the word among them, and whole words
    by another hash. Equal hashes of different parts only make one feature of two.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer(f"^{'$^'.join(words)}$".encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64) if words else np.zeros(0, np.uint64)
    word_of = np.repeat(np.arange(len(words)), lengths)
    whole = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    hashed, owner = [whole], [np.arange(len(words))]
    for length in PART_LENGTHS:
        size = max(len(codes) - length + 1, 0)
        key = np.full(size, length, np.uint64)
        for i in range(length):
            key = (key * MULTIPLIER) ^ codes[i : i + size]
            key ^= key >> np.uint64(29)
        inside = word_of[:size] == word_of[length - 1 :]
        hashed.append((key * MULTIPLIER)[inside])
        owner.append(word_of[:size][inside])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashed)[order].view(np.int64), np.bincount(owner, minlength=len(words))


def restorer_of(costs: bytes, name: str) -> Restorer:
    """The worker's restorer for the language model of that name."""
    cache = worker_cache()
    if cache.get("restorer", ("", None))[0] != name:
        table = np.frombuffer(costs).reshape((CLASSES,) * ORDER)
        cache["restorer"] = (name, Restorer(table))
    return cache["restorer"][1]


def pairs_of(restored: Restored) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, word) once, and how often it occurs."""
    size = len(restored.words) + 1
    keys, counts = np.unique(restored.text * size + restored.codes, return_counts=True)
    return keys // size, keys % size, counts


def expanded(
    restored: Restored, parts: np.ndarray, per_word: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, part) once, and how often it occurs, from the words' parts below ``size``."""
    texts, codes, counts = pairs_of(restored)
    starts = np.cumsum(per_word) - per_word
    long = per_word[codes]
    inside = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
    keys = np.repeat(texts, long) * size + parts[np.repeat(starts[codes], long) + inside]
    keys, place = np.unique(keys, return_inverse=True)
    sums = np.bincount(place, np.repeat(counts, long), len(keys))
    return keys // size, keys % size, sums


def count_parts(rows: DataFrame, model: tuple) -> DataFrame:
    """``part, toxic, clean``: training documents of either label that hold each part of a word."""
    costs, name = model

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_of(costs.value, name)
        for block in text_blocks(batches, "text", TRAINING_BYTES):
            restored = restored_words(block.column("text"), restorer)
            hashed, per_word = word_parts(restored.words)
            known, parts = np.unique(hashed, return_inverse=True)
            texts, held, _ = expanded(restored, parts, per_word, len(known) + 1)
            toxic = block.column("toxic").to_numpy(zero_copy_only=False)[texts] == 1
            yes = np.bincount(held[toxic], minlength=len(known))
            no = np.bincount(held[~toxic], minlength=len(known))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(known),
                    "toxic": pa.array(yes, pa.int64()),
                    "clean": pa.array(no, pa.int64()),
                }
            )

    counted = rows.select("text", "toxic").mapInArrow(blocks, "part long, toxic long, clean long")
    return counted.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def telling_parts(counts: DataFrame, toxic: int, clean: int) -> np.ndarray:
    """Sorted hashes of at most MAX_PARTS parts that toxic documents hold more often, the surest first."""
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    apart = F.col("toxic") / toxic - F.col("clean") / clean
    # Shares of both kinds of documents, pooled; a part that all documents hold tells nothing.
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    z = F.when(spread > 0, apart / spread)
    often = counts.where(F.col("toxic") + F.col("clean") >= MIN_DOCS).withColumn("z", z)
    best = often.where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "part").limit(MAX_PARTS)
    return np.array(sorted(row["part"] for row in best.collect()), np.int64)


def held_parts(
    block: pa.RecordBatch, restorer: Restorer, telling: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, part, log2(1 + occurrences)) of the telling parts that texts hold."""
    restored = restored_words(block.column("text"), restorer)
    hashed, per_word = word_parts(restored.words)
    places = np.searchsorted(telling, hashed)
    found = places < len(telling)
    found[found] = telling[places[found]] == hashed[found]
    word_of = np.repeat(np.arange(len(per_word)), per_word)[found]
    per_word = np.bincount(word_of, minlength=len(per_word))
    texts, held, counts = expanded(restored, places[found], per_word, len(telling) + 1)
    return texts, held, np.log2(1 + counts)


def fit(rows: DataFrame, model: tuple, parts: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the parts and the intercept."""
    costs, name = model

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_of(costs.value, name)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            texts, held, values = held_parts(block, restorer, parts)
            stops = np.searchsorted(texts, np.arange(block.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pc.cast(block.column("toxic"), pa.float64()),
                    "held": pa.ListArray.from_arrays(stops, pa.array(held, pa.int32())),
                    "amounts": pa.ListArray.from_arrays(stops, pa.array(values, pa.float64())),
                }
            )

    shape = "label double, held array<int>, amounts array<double>"
    stored = materialize(rows.select("text", "toxic").mapInArrow(blocks, shape), "toxic-features")
    vector = F.udf(lambda held, amounts: Vectors.sparse(len(parts), held, amounts), VectorUDT())
    features = stored.select("label", vector("held", "amounts").alias("features"))
    fitted = LogisticRegression(regParam=0.01, maxIter=60).fit(features)
    return fitted.coefficients.toArray(), float(fitted.intercept)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most MAX_LABELLED labelled documents, those with the least hash of
    their number. A document labelled twice counts as toxic if one label says so."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # The bound of the sample is that of the broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")


SCORED = "doc_id long, score double"


def score_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (doc_id, text; other columns are ignored), with a
    model of the texts of all ``docs`` and a classifier fitted on ``labels`` (doc_id, toxic)."""
    context = docs.sparkSession.sparkContext
    model = (context.broadcast(language_model(docs).tobytes()), uuid.uuid4().hex)
    rows = materialize(training_rows(docs, labels), "toxic-training")
    numbers = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    toxic, clean = numbers.get(1, 0), numbers.get(0, 0)
    parts, weights = np.zeros(0, np.int64), np.zeros(0)
    intercept = np.log((toxic + 0.5) / (clean + 0.5))
    if toxic and clean:
        parts = telling_parts(count_parts(rows, model), toxic, clean)
        if len(parts):
            weights, intercept = fit(rows, model, parts)
    costs, name = model

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_of(costs.value, name)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            texts, held, values = held_parts(block, restorer, parts)
            odds = intercept + np.bincount(texts, values * weights[held], block.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": block.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-odds)))}
            )
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(blocks, SCORED)


def restore_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of every text restored, joined by blanks."""
    context = docs.sparkSession.sparkContext
    costs, name = context.broadcast(language_model(docs).tobytes()), uuid.uuid4().hex

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = restorer_of(costs.value, name)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            restored = restored_words(block.column("text"), restorer)
            stops = np.searchsorted(restored.text, np.arange(block.num_rows + 1)).astype(np.int32)
            words = pa.array(restored.words, pa.string()).take(pa.array(restored.codes))
            lists = pa.ListArray.from_arrays(stops, words)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": block.column("doc_id"), "text": pc.binary_join(lists, " ")}
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(blocks, "doc_id long, text string")
