"""Benchmark decontamination: every passage of every document queries an index of test items.

The index holds BM25 impacts of the items' terms, in blocks of items of similar length. An item's
weak terms cannot reach the threshold by themselves, so only passages with enough of its strong
terms are looked at; the greatest impacts in the item's block bound what they can score, and those
that could reach the threshold are scored in full. What is retrieved is verified by the overlap of
its question and its answer. No passage is skipped otherwise.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from reviewlab.llm.tokens import gather, split_words, text_blocks
from reviewlab.session import materialize

K1, B = 1.2, 0.75
#: Share of an item's greatest possible score that a passage must reach.
MIN_SCORE = 0.5
#: Share of the n-grams of question and answer that the passage must hold.
MIN_OVERLAP = 0.8
GRAM = 5
#: Items in a block of the index.
BLOCK_ITEMS = 64
#: Share of the needed score that an item's weak terms may reach together.
WEAK_SHARE = 0.8
#: Bytes of item text in one part of the index, of which one is broadcast at a time.
INDEX_BYTES = 16 << 20

NOT_WORD = r"[^\p{L}\p{N}_]+"
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def as_terms(words: pa.Array) -> pa.Array:
    """Words in lower case without punctuation; empty if nothing is left."""
    return pc.replace_substring_regex(pc.utf8_lower(words), NOT_WORD, "")


def terms_of(text: str) -> list[str]:
    words = as_terms(pa.array(text.split(), pa.string()))
    return [t for t in words.to_pylist() if t]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Terms of the question, and of the answer: the last sentence if there are several."""
    sentences = [s for s in SENTENCE_END.split(text.strip()) if terms_of(s)]
    if len(sentences) < 2:
        return terms_of(text), terms_of(text)
    return terms_of(" ".join(sentences[:-1])), terms_of(sentences[-1])


def overlap(wanted: list[str], found: list[str]) -> float:
    """Share of the distinct n-grams of ``wanted`` in ``found``; n is at most len(wanted)."""
    n = min(GRAM, len(wanted))
    grams = lambda words: {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    own = grams(wanted)
    return len(own & grams(found)) / len(own)


@dataclass
class Block:
    """Items of similar length: their numbers, sparse impacts, and what bounds them.

    ``own`` are the sorted terms of the block and ``bound`` the greatest impact of each. Item i has
    the ``values`` from ``edges[i]`` to ``edges[i + 1]``, of the terms at these ``places`` in ``own``.
    """

    items: np.ndarray
    own: np.ndarray
    bound: np.ndarray
    edges: np.ndarray
    places: np.ndarray
    values: np.ndarray
    needed: np.ndarray
    longest: int
    vocabulary: int

    def present(self, words: np.ndarray) -> np.ndarray:
        """Which terms of the block are among ``words``."""
        found = np.zeros(len(self.own), bool)
        at = np.searchsorted(self.own, words)
        inside = at < len(self.own)
        at, words = at[inside], words[inside]
        found[at[self.own[at] == words]] = True
        return found

    def score(self, column: int, present: np.ndarray) -> float:
        mine = slice(self.edges[column], self.edges[column + 1])
        return float(self.values[mine][present[self.places[mine]]].sum())

    @property
    def rows(self) -> np.ndarray:
        """The row of each term in ``impacts``; the last, of zeros, for terms of other blocks."""
        rows = np.full(self.vocabulary + 1, len(self.own))
        rows[self.own] = np.arange(len(self.own))
        return rows

    @property
    def impacts(self) -> np.ndarray:
        """All impacts, terms x items, for comparisons; searching needs the sparse ones only."""
        dense = np.zeros((len(self.own) + 1, len(self.items)), np.float32)
        dense[self.places, np.repeat(np.arange(len(self.items)), np.diff(self.edges))] = self.values
        return dense


class Index:
    """BM25 impacts of test items (number, text) with document frequencies of all items."""

    def __init__(self, items: list[tuple[int, str]], seen: dict[str, int], n: int, mean: float):
        terms = {number: terms_of(text) for number, text in items}
        self.parts = {number: question_and_answer(text) for number, text in items}
        names = sorted({t for found in terms.values() for t in found})
        self.names = pa.array(names, pa.string())
        self.ids = {name: i for i, name in enumerate(names)}
        weights = np.array([np.log1p((n - seen[t] + 0.5) / (seen[t] + 0.5)) for t in names])
        order = sorted(terms, key=lambda number: (len(terms[number]), number))
        self.blocks = []
        strong: list[tuple[int, int, float]] = []
        for first in range(0, len(order), BLOCK_ITEMS):
            numbers = order[first : first + BLOCK_ITEMS]
            own = np.array(sorted({self.ids[t] for number in numbers for t in terms[number]}))
            places, values, edges = [], [], [0]
            for number in numbers:
                size, counted = len(terms[number]), Counter(terms[number])
                ids = np.array([self.ids[name] for name in counted])
                counts = np.array(list(counted.values()), np.float64)
                tf = counts * (K1 + 1) / (counts + K1 * (1 - B + B * size / mean))
                places.append(np.searchsorted(own, ids))
                values.append((weights[ids] * tf).astype(np.float32))
                edges.append(edges[-1] + len(ids))
            bound = np.zeros(len(own), np.float32)
            for mine, impact in zip(places, values):
                bound[mine] = np.maximum(bound[mine], impact)
            needed = np.array([MIN_SCORE * impact.sum() for impact in values], np.float32)
            for column, (mine, impact) in enumerate(zip(places, values)):
                ascending = np.argsort(impact, kind="stable")
                weak = np.cumsum(impact[ascending]) <= WEAK_SHARE * needed[column]
                for at in ascending[~weak].tolist():
                    strong.append((int(own[mine[at]]), first + column, float(impact[at])))
            longest = max(len(terms[number]) for number in numbers)
            self.blocks.append(
                Block(
                    np.array(numbers), own, bound, np.array(edges), np.concatenate(places),
                    np.concatenate(values), needed, longest, len(names),
                )
            )
        strong.sort()
        posted, self.place, impact = (np.array(x) for x in zip(*strong))
        self.impact = impact.astype(np.float64)
        self.edges = np.searchsorted(posted, np.arange(len(names) + 1))
        self.step = np.concatenate([np.full(len(b.items), max(b.longest, 1)) for b in self.blocks])
        self.least = np.concatenate([b.needed for b in self.blocks]) * (1 - WEAK_SHARE)

    def to_bytes(self) -> bytes:
        """The index as plain arrays, which workers can load without this package."""
        plain = {**vars(self), "blocks": [vars(block) for block in self.blocks]}
        return pickle.dumps(plain, pickle.HIGHEST_PROTOCOL)

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        index = cls.__new__(cls)
        vars(index).update(pickle.loads(data))
        index.blocks = [Block(**block) for block in index.blocks]
        return index

    def candidates(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(place of an item, window) where the strong terms of the item reach their share.

        The weak terms of an item are those of the least impact, which together stay below
        WEAK_SHARE of what is needed; the strong ones must give the rest. A window is two halves;
        a term counts once in each, which can only be too much.
        """
        places = np.flatnonzero(words >= 0)
        terms = words[places]
        counts = self.edges[terms + 1] - self.edges[terms]
        posting = gather(self.edges[terms], counts)
        item = self.place[posting]
        half = np.repeat(places, counts) // self.step[item]
        halves = len(words) + 2
        once, kept = np.unique(
            (item * halves + half) * (len(self.edges)) + np.repeat(terms, counts),
            return_index=True,
        )
        keys, start = np.unique(once // len(self.edges), return_index=True)
        if not len(keys):
            return []
        sums = np.append(np.add.reduceat(self.impact[posting[kept]], start), 0.0)
        windows = np.union1d(keys, (keys - 1)[keys % halves > 0])

        def sum_at(wanted: np.ndarray) -> np.ndarray:
            at = np.searchsorted(keys, wanted)
            found = np.append(keys, -1)[at] == wanted
            return sums[np.where(found, at, len(keys))]

        total = sum_at(windows) + sum_at(windows + 1)
        # Sums of float32 impacts in another order differ by far less than this.
        hits = windows[total >= self.least[windows // halves] * (1 - 1e-4)]
        return list(zip((hits // halves).tolist(), (hits % halves).tolist()))

    def search(self, words: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(item, first, last, share of its greatest score) of passages that reach the threshold.

        ``words`` are term numbers, -1 for terms of no item. Passages are windows of twice the
        block's longest item that start every such length, so any run of words as long as an item
        lies in one of them whole. What the strong terms leave is bounded by the block's greatest
        impacts, then scored in full.
        """
        for place, window in self.candidates(words):
            block, column = self.blocks[place // BLOCK_ITEMS], place % BLOCK_ITEMS
            first = window * max(block.longest, 1)
            last = min(first + 2 * max(block.longest, 1), len(words))
            present = block.present(words[first:last])
            least = float(block.needed[column]) * (1 - 1e-4)
            if block.bound[present].sum() < least:
                continue
            score = block.score(column, present)
            if score >= least:
                share = score * MIN_SCORE / float(block.needed[column])
                yield int(block.items[column]), first, last, share


HITS = ArrayType(
    StructType(
        [
            StructField("item", LongType()),
            StructField("score", DoubleType()),
            StructField("question", DoubleType()),
            StructField("answer", DoubleType()),
        ]
    )
)


def hits_in(index: Index, texts: pa.Array) -> list[list[tuple]]:
    """Per text the verified items: (item, score, question overlap, answer overlap)."""
    codes, per_text, distinct = split_words(texts)
    names = as_terms(distinct)
    real = pc.not_equal(names, "").to_numpy(zero_copy_only=False)
    number = pc.fill_null(pc.index_in(names, index.names), -1).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), per_text)
    stays = real[codes] if len(codes) else np.zeros(0, bool)
    codes, owner = codes[stays], owner[stays]
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    best: list[dict] = [{} for _ in range(len(texts))]
    # Windows run over the texts of the block in one stream. A window over a border can only
    # find more; what it finds is verified in each text alone.
    for item, first, last, score in index.search(number[codes]):
        question, answer = index.parts[item]
        margin = last - first
        for text in range(int(owner[first]), int(owner[last - 1]) + 1):
            low = max(int(edges[text]), first - margin)
            high = min(int(edges[text + 1]), last + margin)
            if item in best[text] and best[text][item][0] >= score:
                continue
            words = names.take(pa.array(codes[low:high])).to_pylist()
            found = overlap(question, words), overlap(answer, words)
            if min(found) >= MIN_OVERLAP:
                best[text][item] = (score, *found)
    return [[(item, *row) for item, row in sorted(found.items())] for found in best]


def item_indexes(items: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """(the items with a number each, a stored table ``part, index``, number of parts).

    Document frequencies are those of all items. A part has about INDEX_BYTES of text; it is
    built in one task and is a row of the table. Items without terms are in no index, so a part
    may have no row.
    """
    numbered = materialize(
        items.select("*", F.col(text).alias("item_text")).select(
            F.monotonically_increasing_id().alias("item"), F.struct(*items.columns).alias("of"),
            "item_text",
        ),
        "benchmark-items",
    )
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    parts = -(-int(size) // INDEX_BYTES)

    def each_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [terms_of(t or "") for t in batch.column("item_text").to_pylist()]
            found = pa.array(terms, pa.list_(pa.string()))
            columns = [*(batch.column(c) for c in ("item", "part", "item_text")), found]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "part", "item_text", "terms"])

    part = F.pmod(F.xxhash64("item"), F.lit(max(parts, 1))).alias("part")
    found = materialize(
        numbered.select("item", part, "item_text")
        .mapInArrow(each_term, "item long, part long, item_text string, terms array<string>")
        .where("size(terms) > 0"),
        "item-terms",
    )
    n, mean = found.agg(F.count("*"), F.avg(F.size("terms"))).first()
    seen = (
        found.select("part", F.explode(F.array_distinct("terms")).alias("term"))
        .groupBy("part", "term")
        .agg(F.count("*").alias("count"))
        .withColumn("count", F.sum("count").over(Window.partitionBy("term")))
    )

    def build(key: tuple, own: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(zip(own["item"].tolist(), own["item_text"].tolist()))
        frequencies = dict(zip(counts["term"].tolist(), counts["count"].tolist()))
        index = Index(texts, frequencies, n, mean)
        return pd.DataFrame({"part": [int(key[0])], "index": [index.to_bytes()]})

    indexes = (
        found.select("part", "item", "item_text")
        .groupBy("part")
        .cogroup(seen.groupBy("part"))
        .applyInPandas(build, "part long, index binary")
    )
    return numbered, materialize(indexes, "item-indexes"), parts


def searcher(shared: Broadcast) -> Callable[[pa.Array], pa.Array]:
    """The function that looks for the items of a broadcast index in a batch of texts."""
    loaded: list[Index] = []

    def search(texts: pa.Array) -> pa.Array:
        if not loaded:
            loaded.append(Index.from_bytes(shared.value))
        out = []
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        for block in text_blocks(iter([batch]), "text"):
            out.extend(hits_in(loaded[0], block.column("text")))
        names = [field.name for field in HITS.elementType.fields]
        kinds = [pa.int64(), *[pa.float64()] * (len(names) - 1)]
        return pa.array(
            [[dict(zip(names, hit)) for hit in found] for found in out],
            pa.list_(pa.struct(list(zip(names, kinds)))),
        )

    return search


def passes(
    docs: DataFrame, indexes: DataFrame, parts: int, search: Callable[[Column], DataFrame],
    text: str = "text",
) -> Iterator[DataFrame]:
    """``search`` of the documents for each part of the index.

    ``search`` gets array<struct<item, score, question, answer>>, the items of the part that a text
    holds. One part, of bounded size, is read and broadcast at a time: if there are several, what
    one finds is stored before the next is read.
    """
    context = docs.sparkSession.sparkContext
    for part in range(parts):
        row = indexes.where(F.col("part") == part).select("index").first()
        if row is None:
            continue
        shared = context.broadcast(bytes(row["index"]))
        found = search(F.arrow_udf(searcher(shared), HITS)(F.col(text)))
        if parts > 1:
            found = materialize(found, "leaks")
            shared.destroy()
        yield found


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and test item in it: doc_id, item_id, score, question, answer.

    ``score`` is the best passage's share of the item's greatest BM25 score, the others the
    overlaps; all rounded to six digits. Null and empty texts hold nothing, items without words
    are not searched, repeated documents or items each have their rows. Without items the result
    is empty.
    """
    numbered, indexes, parts = item_indexes(items)
    nothing = docs.limit(0).select("doc_id", F.explode(F.array().cast(HITS)).alias("hit"))
    each = passes(docs, indexes, parts, lambda hits: docs.select("doc_id", F.explode(hits).alias("hit")))
    found = reduce(DataFrame.unionByName, each, nothing)
    known = numbered.select("item", F.col("of.item_id").alias("item_id"))
    return found.join(known, F.col("hit.item") == F.col("item")).select(
        "doc_id",
        "item_id",
        *[F.round(f"hit.{c}", 6).alias(c) for c in ("score", "question", "answer")],
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item.

    With one part of the index that is a filter. With several, each pass stores the digests of the
    texts in which it finds an item, and the documents with such a text go.
    """
    _, indexes, parts = item_indexes(items)
    if parts <= 1:
        return next(passes(docs, indexes, parts, lambda hits: docs.where(F.size(hits) == 0)), docs)
    digest = F.sha2("text", 256)
    each = passes(
        docs, indexes, parts, lambda hits: docs.where(F.size(hits) > 0).select(digest.alias("leak"))
    )
    leaky = reduce(DataFrame.unionByName, each, docs.limit(0).select(digest.alias("leak")))
    leaky = leaky.distinct()
    return docs.join(leaky, F.sha2(docs["text"], 256) == leaky["leak"], "left_anti")
