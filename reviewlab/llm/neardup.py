"""Near-duplicates by SetSketch registers.

A document's registers are truncated logarithms of the minima of exponential variables over its
shingles: mergeable by the maximum, and equal in two documents about as often as their sets
agree. Bands of registers propose pairs, the joint likelihood of all registers estimates their
similarity, and what may be similar is verified on the full sets. Components are found without
listing the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from reviewlab.llm.common import packed
from reviewlab.llm.components import components
from reviewlab.llm.tokens import split_words, text_blocks
from reviewlab.session import materialize, scratch_path

#: Words in a shingle, and per cent of the union that linked documents share.
SHINGLE = 5
PERCENT = 80
#: Registers of a sketch, and how often two sets at the threshold may have no band in common.
REGISTERS = 120
MISSED = 1e-6
#: Parameters of the registers: base, rate, and the largest value.
BASE, RATE, LARGEST = 1.001, 20.0, 2**16 - 1
#: A pair is verified if the estimate is at most so far below the threshold: five deviations.
SLACK = 0.18
#: Parts into which the members that have an element are dealt.
SALTS = 16

MULTIPLY = np.random.default_rng(20240601).integers(0, 2**63, REGISTERS, np.uint64) * 2 + 1
STIR = np.uint64(0xD6E8FEB86659FD93)
WORD_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * STIR
    x = (x ^ (x >> np.uint64(29))) * STIR
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles.

    A text with fewer words than a shingle has has its whole sequence as the only one; a text
    without words has none. A to Z are lowered first.
    """
    import xxhash

    codes, per_text, distinct = split_words(pc.ascii_lower(texts.fill_null("")))
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()] or [0], np.uint64)
    words = hashes[codes]
    stops = np.cumsum(per_text)
    n = max(len(words) - shingle + 1, 0)
    joined = np.zeros(n, np.uint64)
    for place in range(shingle):
        key = np.uint64(WORD_KEYS[place % 3] ^ (place // 3))
        joined = stir(joined + words[place : place + n] * key)
    sets = []
    for first, stop in zip((stops - per_text).tolist(), stops.tolist()):
        if stop - first >= shingle:
            sets.append(np.unique(joined[first : stop - shingle + 1]))
        elif stop > first:
            own = np.zeros(1, np.uint64)
            for place in range(first, stop):
                own = stir(own + words[place : place + 1] * np.uint64(WORD_KEYS[(place - first) % 3]))
            sets.append(stir(own + np.uint64(stop - first)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def registers(found: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes, as 16-bit numbers.

    The k-th register is the truncated logarithm of the least of independent exponential
    variables, one per element; the least uniform variable gives it.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(found), 4096):
        mixed = found[None, first : first + 4096] * MULTIPLY[:, None]
        mixed ^= mixed >> np.uint64(32)
        mixed *= STIR
        np.minimum(least, mixed.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-uniform) / RATE
    raised = np.floor(1 - np.log(exponential) / np.log(BASE))
    return np.clip(raised, 0, LARGEST).astype("<u2")


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def banding(percent: int) -> tuple[int, int]:
    """(bands, registers in a band): the longest bands that miss a link at most MISSED times."""
    for length in range(12, 0, -1):
        bands = REGISTERS // length
        if (1 - (percent / 100) ** length) ** bands <= MISSED:
            return bands, length
    return REGISTERS, 1


def band_keys(sketches: np.ndarray, bands: int, length: int) -> np.ndarray:
    """One 64-bit key per band of each sketch (rows), different in every band."""
    cut = sketches[:, : bands * length].reshape(len(sketches), bands, length).astype(np.uint64)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketches), 1))
    for place in range(length):
        keys = stir(keys + cut[:, :, place])
    return keys.view(np.int64)


def likely_similarity(
    one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray
) -> np.ndarray:
    """Jaccard similarity of pairs by maximum likelihood of how their registers compare.

    Rows are pairs. With known sizes the numbers of greater, smaller and equal registers are
    multinomial with probabilities that depend on the similarity alone; their log-likelihood is
    concave in it and is maximised by golden sections.
    """
    greater = (one > other).sum(axis=1)
    smaller = (one < other).sum(axis=1)
    equal = one.shape[1] - greater - smaller
    u = n_one / (n_one + n_other)
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        x = np.clip(x, 0, 1)
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, less = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        same = np.maximum(1 - more - less, tiny)
        return (
            greater * np.log(np.maximum(more, tiny))
            + smaller * np.log(np.maximum(less, tiny))
            + equal * np.log(same)
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(30):
        a, b = high - golden * (high - low), low + golden * (high - low)
        left = likelihood(a) > likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


SKETCH = "n_shingles long, digest binary, sketch binary"


def sketches(
    docs: DataFrame, text: str = "text", carry: list[str] | None = None, shingle: int = SHINGLE
) -> DataFrame:
    """Per row rid, row (the columns ``carry``, or all but the text, and doc_id), doc_id, text,
    n_shingles, digest (of the set) and sketch; stored.

    The last two are null for an empty set.
    """
    columns = [c for c in docs.columns if c != text] if carry is None else carry
    rows = packed(
        docs, ["doc_id", *[c for c in columns if c != "doc_id"]],
        doc_id=F.col("doc_id").cast("long"), text=F.col(text),
    )
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(SKETCH).fields])

    def sketch_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for block in text_blocks(batches, "text"):
            sets = shingle_sets(block.column("text"), shingle)
            own = [registers(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *block.columns,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array([None if r is None else r.tobytes() for r in own], pa.binary()),
                ],
                names=[*block.schema.names, "n_shingles", "digest", "sketch"],
            )

    spark = docs.sparkSession
    path = scratch_path(spark, "sketches")
    rows.mapInArrow(sketch_blocks, schema).select(
        F.monotonically_increasing_id().alias("rid"), "*"
    ).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow a link and whose estimate is not far below it."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                for c in ("sketch_a", "sketch_b")
            )
            n_one, n_other = (
                batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")
            )
            found = likely_similarity(one, other, n_one, n_other)
            yield batch.select(["a", "b"]).filter(pa.array(found >= percent / 100 - SLACK))

    sides = [
        reps.select(
            F.col("rid").alias(side),
            F.col("n_shingles").alias(f"n_{side}"),
            F.col("sketch").alias(f"sketch_{side}"),
        )
        for side in ("a", "b")
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return both.where(sized).mapInArrow(estimate, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets share enough. Each text is cut into shingles once."""

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets = shingle_sets(block.column("text"), shingle)
            yield pa.RecordBatch.from_arrays(
                [block.column("rid"), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["rid", "shingles"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, other))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    sets = materialize(
        rows.join(needed, "rid", "left_semi")
        .select("rid", "text")
        .mapInArrow(full_sets, "rid long, shingles binary"),
        "shingle-sets",
    )
    sides = [
        sets.select(F.col("rid").alias(side), F.col("shingles").alias(f"set_{side}"))
        for side in ("a", "b")
    ]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(compare, "a long, b long")


def band_members(reps: DataFrame, percent: int) -> DataFrame:
    """(rid, band): the representatives in each of their bands."""
    bands, length = banding(percent)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("sketch").to_pylist())
            keys = band_keys(np.frombuffer(raw, "<u2").reshape(-1, REGISTERS), bands, length)
            rids = np.repeat(batch.column("rid").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids), pa.array(keys.ravel())], names=["rid", "band"]
            )

    return reps.select("rid", "sketch").mapInArrow(cut, "rid long, band long")


def star_pairs(groups: DataFrame) -> DataFrame:
    """Each member of a group with the group's pivot, as distinct pairs (a, b).

    The pivot is the member whose groups are the largest together: in a family of near copies
    that is the text the others were made from, or one close to it.
    """
    weights = groups.groupBy("rid").agg(F.sum("n").alias("weight"))
    weighted = groups.join(weights, "rid")
    pivots = weighted.groupBy("band").agg(F.max_by("rid", "weight").alias("pivot"))
    return (
        groups.join(materialize(pivots, "pivots"), "band")
        .where("rid <> pivot")
        .select(F.greatest("rid", "pivot").alias("a"), F.least("rid", "pivot").alias("b"))
        .distinct()
    )


def open_members(groups: DataFrame, found: DataFrame) -> DataFrame:
    """(rid, component) of the members of groups that still span several components."""
    labelled = groups.join(found, F.col("rid") == F.col("node"), "left").select(
        "band", "rid", F.coalesce("component", "rid").alias("component")
    )
    labelled = materialize(labelled, "labelled-groups")
    spans = labelled.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    live = spans.where("low < high").select("band")
    return labelled.join(live, "band", "left_semi").select("rid", "component").distinct()


def prefix_pairs(
    members: DataFrame, rows: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """All pairs (a, b) of members in different components that could be linked, by exact rules.

    Two sets that share c elements have one in common among the first n - c + 1 of each, in any
    order; taking the rarest first makes those lists short of partners. Elements of one member
    only take up their places but join nothing. A pair needs a side outside of the element's
    commonest component, so the members of a large component are not paired with each other; an
    element that very many of them have is dealt out by a salt.
    """

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets = shingle_sets(block.column("text"), shingle)
            sizes = np.array([len(s) for s in sets], np.int64)
            both = pa.RecordBatch.from_arrays(
                [block.column("rid"), block.column("component"), pa.array(sizes)],
                names=["rid", "component", "n"],
            ).take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
            found = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*both.columns, pa.array(found.view(np.int64))], names=[*both.schema.names, "e"]
            )

    texts = rows.select("rid", "text").join(members, "rid")
    exploded = materialize(
        texts.mapInArrow(elements, "rid long, component long, n long, e long"), "elements"
    )
    shared = exploded.groupBy("e").agg(F.count("*").alias("df")).where("df > 1")
    common = exploded.join(shared, "e")
    inside = Window.partitionBy("rid")
    place = (
        F.col("n")
        - F.count("*").over(inside)
        + F.row_number().over(inside.orderBy("df", "e"))
    )
    longest = F.expr(f"n - (({percent} * n + 99) div 100) + 1")
    prefix = materialize(
        common.select("rid", "component", "n", "e", place.alias("place")).where(
            F.col("place") <= longest
        ),
        "prefixes",
    )
    sizes = prefix.groupBy("e", "component").agg(F.count("*").alias("size"))
    spans = sizes.groupBy("e").agg(
        F.max_by("component", "size").alias("major"), F.count("*").alias("components")
    )
    # Stored, so that the join below is one that Spark can split where an element is frequent.
    spans = materialize(spans.where("components > 1").select("e", "major"), "element-spans")
    held = prefix.join(spans, "e")
    columns = ("rid", "component", "n", "place")
    left, right = (
        held.select("e", "major", *[F.col(c).alias(f"{c}_{side}") for c in columns])
        for side in ("x", "y")
    )
    left = left.where("component_x <> major").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    right = right.drop("major").withColumn("salt", F.pmod(F.xxhash64("rid_y"), F.lit(SALTS)))
    least = F.expr(f"({percent} * (n_x + n_y) + {99 + percent}) div {100 + percent}")
    fits = (
        (F.col("component_x") != F.col("component_y"))
        & (F.col("place_x") <= F.col("n_x") - least + 1)
        & (F.col("place_y") <= F.col("n_y") - least + 1)
        & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
    )
    return (
        left.join(right.withColumn("salt", F.col("salt").cast("int")), ["e", "salt"])
        .where(fits)
        .select(F.greatest("rid_x", "rid_y").alias("a"), F.least("rid_x", "rid_y").alias("b"))
        .distinct()
    )


def linked_components(
    rows: DataFrame, reps: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """(node, component) of the representatives that are linked to others.

    Representatives with a band in common are a group. First every member is compared with the
    pivot of its groups, one comparison per member. A group that is in one component then has no
    link left that matters. The members of the others are paired by exact rules, so no link
    between two components is lost, however large a group is.
    """
    members = band_members(reps, percent)
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # Stored, so that the join with a band that very many share can be split.
    groups = materialize(members.join(materialize(sizes, "band-sizes"), "band"), "band-groups")
    links = checked(star_pairs(groups), rows, reps, shingle, percent)
    found = materialize(components(links), "components")
    members = materialize(open_members(groups, found), "open-members")
    if members.isEmpty():
        return found
    pairs = prefix_pairs(members, rows, shingle, percent)
    more = checked(pairs, rows, reps, shingle, percent)
    if more.isEmpty():
        return found
    return materialize(components(links.unionByName(more)), "components")


def checked(
    pairs: DataFrame, rows: DataFrame, reps: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """The pairs that are links: first by the estimate, then on the full sets; stored."""
    likely = materialize(plausible(materialize(pairs, "pairs"), reps, percent), "likely-pairs")
    return materialize(verified(likely, rows, shingle, percent), "links")


def component_ids(
    rows: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``sketches``: rid, doc_id, n_shingles, component, component_id, kept."""
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("rid").alias("rep"), F.min("doc_id").alias("least")
    )
    classes = materialize(classes, "classes")
    reps = rows.join(classes.select(F.col("rep").alias("rid")), "rid", "left_semi").select(
        "rid", "n_shingles", "sketch"
    )
    reps = materialize(reps, "representatives")
    found = linked_components(rows, reps, shingle, percent)
    joined = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", "least", F.coalesce("component", "rep").alias("component")
    )
    joined = materialize(joined, "class-components")
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = materialize(
        joined.join(smallest, "component").select("digest", "component", "component_id"),
        "class-ids",
    )
    done = rows.select("rid", "doc_id", "n_shingles", "digest").join(per_class, "digest", "left")
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id")
    )
    return done.select(
        "rid",
        "doc_id",
        "n_shingles",
        F.coalesce("component", F.col("rid")).alias("component"),
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach, kept says that it is the row's own. A
    text without words, or null, has an empty set and is alone. Rows that share a doc_id are rows
    of their own; a null doc_id is no smallest one unless the whole component has none. Equal
    sets are merged before anything is compared.
    """
    found = component_ids(sketches(docs, text, [], shingle), shingle, percent)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of every component, that with the smallest doc_id (of equal ids any one row);
    columns as in ``docs``. Rows without words all stay.

    What goes is taken out, as it is the smaller part; if it is small enough, texts are not
    shuffled for it.
    """
    rows = sketches(docs, text, None, shingle)
    found = materialize(component_ids(rows, shingle, percent), "component-ids")
    stays = found.where("kept").groupBy("component").agg(F.min("rid").alias("rid"))
    gone = materialize(found.join(stays, "rid", "left_anti").select("rid"), "duplicates")
    columns = [
        F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    return rows.join(gone, "rid", "left_anti").select(*columns)
