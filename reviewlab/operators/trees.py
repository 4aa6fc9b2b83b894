"""Trees, forests and boosted trees over wide sparse vectors, as MLlib models.

MLlib's learner holds every row as one number per column, a megabyte at 2^18 columns, however few
entries the row has. Here a row is the list of its bins that do not hold zero; what a node's rows have in
the zero bin is the node's total without the others. Every pass over the rows counts one level of all
trees: bins are counted before the shuffle, each column of a node is judged in a task, and the driver
gets one split per node. Bins, impurity, ties and pruning are those of MLlib, so single and boosted trees
are the same; forests draw rows and columns by their own random numbers. The model is saved in MLlib's form and loaded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.session import materialize, scratch_path

#: Rows that the bins of columns are taken from, as MLlib does: so many, or the square of the bins.
SPLIT_ROWS = 10_000
#: Entries that a task works on together.
BLOCK_ENTRIES = 4_000_000
#: Vectors of so few columns are left to MLlib, as a number for each is no more than the entries.
NARROW = 64
MAX_CLASSES = 100
EPSILON = np.finfo(float).eps
MULTIPLIERS = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass
class Bins:
    """Columns with more than one bin. Bin b of the column at place c is ``offsets[c] + b``."""

    width: int
    columns: np.ndarray
    thresholds: np.ndarray
    starts: np.ndarray

    def __post_init__(self):
        places = np.arange(len(self.columns))
        self.splits = np.diff(self.starts)
        self.offsets = self.starts + np.append(places, len(places))
        self.column_of = np.repeat(places, self.splits + 1)
        self.zero = self.bin_of(places, np.zeros(len(places)))

    def bin_of(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """How many thresholds of its column are below each value."""
        low, high = self.starts[places], self.starts[places + 1]
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = self.thresholds[np.where(open_, middle, 0)]
            above = open_ & ~(at >= values)
            low, high = np.where(above, middle + 1, low), np.where(open_ & ~above, middle, high)
        return low - self.starts[places]


def entries_of(rows: DataFrame, column: str = "features") -> DataFrame:
    """The rows with the places and values of their vectors, sparse or dense."""
    parts = F.unwrap_udt(column)
    last = F.greatest(F.size(parts["values"]) - 1, F.lit(0))
    places = F.coalesce(parts["indices"], F.sequence(F.lit(0), last))
    return rows.withColumns({"columns": places, "amounts": parts["values"]}).drop(column)


def thresholds_of(values: np.ndarray, counts: np.ndarray, rows: float, most: int) -> list[float]:
    """The thresholds of a column from its values that are not zero, among ``rows`` rows."""
    zeros = rows - counts.sum()
    if zeros > EPSILON * counts.sum() * 100:
        values, counts = np.append(values, 0.0), np.append(counts, zeros)
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles.tolist()
    stride, found = rows / (most + 1), []
    target, seen = stride, counts[0]
    for middle, count in zip(middles.tolist(), counts[1:].tolist()):
        if abs(seen - target) < abs(seen + count - target):
            found.append(middle)
            target += stride
        seen += count
    return found


def find_bins(rows: DataFrame, total: int, width: int, max_bins: int, seed: int) -> Bins:
    """Bins of all columns, from a sample of bounded size as in MLlib."""
    wanted = max(max_bins * max_bins, SPLIT_ROWS)
    share = wanted / total if wanted < total else 1.0
    few = rows if share == 1.0 else rows.sample(False, share, seed)
    most = min(max_bins, total) - 1

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for counted in batch.column("counted").to_pylist():
                values = np.array([c["value"] for c in counted])
                counts = np.array([c["n"] for c in counted], float)
                found.append(thresholds_of(values, counts, share * total, most))
            column = batch.column("column")
            yield pa.RecordBatch.from_pydict(
                {"column": column, "thresholds": pa.array(found, pa.list_(pa.float64()))}
            )

    pairs = few.select(F.explode(F.arrays_zip("columns", "amounts")).alias("e"))
    pairs = pairs.select(F.col("e.columns").alias("column"), F.col("e.amounts").alias("value"))
    counted = pairs.where("value <> 0").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    lists = counted.groupBy("column").agg(F.collect_list(F.struct("value", "n")).alias("counted"))
    made = lists.mapInArrow(split, "column int, thresholds array<double>")
    found = sorted((r["column"], r["thresholds"]) for r in made.collect() if r["thresholds"])
    sizes = [len(thresholds) for _, thresholds in found]
    return Bins(
        width,
        np.array([column for column, _ in found], np.int64),
        np.array([t for _, thresholds in found for t in thresholds], float),
        np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64),
    )


def binned(rows: DataFrame, shared) -> DataFrame:
    """``row, target, bins``: the bins of each row that do not hold zero, in rising order."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(*shared.value)
        place_of = np.full(bins.width, -1, np.int64)
        place_of[bins.columns] = np.arange(len(bins.columns))
        for batch in batches:
            lists, amounts = batch.column("columns"), batch.column("amounts").flatten().to_numpy()
            long = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), long)
            place = place_of[lists.flatten().to_numpy(zero_copy_only=False)]
            known = place >= 0
            row, place = row[known], place[known]
            at = bins.bin_of(place, amounts[known])
            used = at != bins.zero[place]
            row, key = row[used], (bins.offsets[place] + at)[used].astype(np.int32)
            stops = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "target": batch.column("target"),
                    "bins": pa.ListArray.from_arrays(stops, pa.array(key)),
                }
            )

    return rows.mapInArrow(put, "row long, target double, bins array<int>")


@dataclass
class Tree:
    """Nodes in the order in which they were made. Without a split, ``column`` is -1."""

    column: list[int] = field(default_factory=list)
    split: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, stats: np.ndarray, depth: int, value: float) -> int:
        self.stats.append(stats)
        self.depth.append(depth)
        self.value.append(value)
        for known, empty in ((self.column, -1), (self.split, -1), (self.left, -1), (self.gain, -1.0)):
            known.append(empty)
        return len(self.column) - 1


@dataclass
class Block:
    """Some rows: ``keys`` are row times the number of bins plus the bin, all in rising order."""

    row: np.ndarray
    target: np.ndarray
    owner: np.ndarray
    bins: np.ndarray
    keys: np.ndarray
    size: int

    def leaves(self, tree: Tree, bins: Bins) -> np.ndarray:
        """The node that each row has come to."""
        column, split, left = (np.array(a, np.int64) for a in (tree.column, tree.split, tree.left))
        node = np.zeros(len(self.row), np.int64)
        going = np.arange(len(node))
        while len(going := going[column[node[going]] >= 0]):
            c, s = column[node[going]], split[node[going]]
            first = going * self.size + bins.offsets[c]
            at = np.searchsorted(self.keys, first)
            key = np.append(self.keys, np.iinfo(np.int64).max)[at]
            held = key < going * self.size + bins.offsets[c + 1]
            is_left = np.where(held, key <= first + s, bins.zero[c] <= s)
            node[going] = left[node[going]] + ~is_left
        return node


def blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    def block(held: list[pa.RecordBatch]) -> Block:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("bins").combine_chunks()
        long = lists.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(long)), long)
        places = lists.flatten().to_numpy()
        row, target = table.column("row").to_numpy(), table.column("target").to_numpy()
        return Block(row, target, owner, places, owner * size + places, size)

    held, entries = [], 0
    for batch in batches:
        held.append(batch)
        entries += len(batch.column("bins").flatten()) + batch.num_rows
        if entries >= BLOCK_ENTRIES:
            yield block(held)
            held, entries = [], 0
    if held:
        yield block(held)


#: Upper bounds of the chance that a row is drawn 0, 1, 2, ... times (Poisson with mean 1).
DRAWN = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 20.0)])))


def drawn(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a forest's tree sees each row."""
    salt = np.random.default_rng([seed % 2**32, tree]).integers(0, 2**63, dtype=np.uint64)
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt
    for shift, multiplier in zip((30, 27), MULTIPLIERS):
        x = (x ^ (x >> np.uint64(shift))) * multiplier
    x ^= x >> np.uint64(31)
    return np.searchsorted(DRAWN, (x >> np.uint64(11)) / 2.0**53, side="right")


def impurity(stats: np.ndarray, classes: int) -> np.ndarray:
    """Gini's impurity of class counts, or the variance from count, sum and sum of squares."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if classes:
            total = stats.sum(axis=-1)
            value = np.ones(total.shape)
            for i in range(classes):
                share = stats[..., i] / total
                value = value - share * share
        else:
            total = stats[..., 0]
            value = (stats[..., 2] - stats[..., 1] * stats[..., 1] / total) / total
    return np.where(total == 0, 0.0, value)


def weight(stats: np.ndarray, classes: int) -> np.ndarray:
    return stats.sum(axis=-1) if classes else stats[..., 0]


def prediction(stats: np.ndarray, classes: int) -> float:
    return float(np.argmax(stats)) if classes else float(stats[1] / stats[0])


@dataclass
class Learner:
    """Grows trees level by level. ``classes`` is 0 for numbers; ``columns`` are drawn for every node;
    ``rates`` of the ``before`` trees are set when a tree learns what these leave."""

    rows: DataFrame
    bins: Bins
    shared: object
    classes: int
    max_depth: int
    seed: int
    memory: int
    columns: int
    bagged: bool
    before: list[Tree] = field(default_factory=list)
    rates: list[float] = field(default_factory=list)

    def counted(self, trees: list[Tree], nodes: list[list[int]], totals: bool) -> DataFrame:
        """``node, place, key, s0, s1, ...``: what rows in the nodes of each tree hold by column and
        bin, or (``totals``) under key 0 all together. Nodes are numbered through, tree after tree."""
        shared, classes, seed, memory = self.shared, self.classes, self.seed, self.memory
        columns, bagged, before, rates = self.columns, self.bagged, self.before, self.rates
        size = max(len(self.bins.column_of), 1)
        width = classes or 3
        names = [f"s{i}" for i in range(width)]

        def sums(keys: np.ndarray, values: list, first: int, n: int, places) -> pa.RecordBatch:
            """One row for each node and key (node times ``size`` plus key)."""
            if n * size <= max(4 * len(keys), 1 << 16) and n * size * 8 * (width + 1) <= memory:
                held = np.flatnonzero(np.bincount(keys, minlength=n * size))
                added = [np.bincount(keys, v, n * size)[held] for v in values]
            else:
                held, inverse = np.unique(keys, return_inverse=True)
                added = [np.bincount(inverse, v, len(held)) for v in values]
            node, key = held // size, held % size
            made = {"node": pa.array(node + first), "place": pa.array(places[key]), "key": pa.array(key)}
            made |= {name: pa.array(a.astype(float)) for name, a in zip(names, added)}
            return pa.RecordBatch.from_pydict(made)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = Bins(*shared.value)
            for block in blocks_of(batches, size):
                target = block.target
                if before:
                    guess = sum(
                        rate * np.array(tree.value)[block.leaves(tree, bins)]
                        for tree, rate in zip(before, rates)
                    )
                    target = 2.0 * (target - guess)
                first = 0
                for number, (tree, open_nodes) in enumerate(zip(trees, nodes)):
                    if not open_nodes:
                        continue
                    local = np.full(len(tree.column) or 1, -1, np.int64)
                    local[open_nodes] = np.arange(len(open_nodes))
                    times = drawn(block.row, number, seed) if bagged else np.ones(len(target))
                    node = local[block.leaves(tree, bins) if tree.column else 0 * block.row]
                    times = times * (node >= 0)
                    if classes:
                        stats = [times * (target == c) for c in range(classes)]
                    else:
                        stats = [times, times * target, times * target * target]
                    if totals:
                        owner = np.flatnonzero(times > 0)
                        key, places = np.zeros(len(owner), np.int64), np.zeros(size, np.int64)
                    else:
                        chosen, places = (times > 0)[block.owner], bins.column_of
                        if columns < bins.width:
                            mask = column_mask(bins, columns, seed, number, open_nodes)
                            chosen &= mask[node[block.owner], places[block.bins]]
                        owner, key = block.owner[chosen], block.bins[chosen]
                    if len(owner):
                        keys, values = node[owner] * size + key, [s[owner] for s in stats]
                        yield sums(keys, values, first, len(open_nodes), places)
                    first += len(open_nodes)

        shape = "node long, place long, key long, " + ", ".join(f"{name} double" for name in names)
        # Dealt by column once; the sums by bin and the lists by column need no second shuffle.
        found = self.rows.mapInArrow(count, shape).repartition("node", "place")
        return found.groupBy("node", "place", "key").agg(*[F.sum(n).alias(n) for n in names])

    def best(self, counts: DataFrame, trees: list[Tree], nodes: list[list[int]]) -> list:
        """The best split of every node that has one: ``node, gain, place, split, left`` (what goes
        left). Ties go to the smaller column, then to the smaller split."""
        shared, classes, width = self.shared, self.classes, self.classes or 3
        known = np.array([tree.stats[n] for tree, open_ in zip(trees, nodes) for n in open_])
        before = impurity(known, classes)
        names = [f"s{i}" for i in range(width)]

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins = Bins(*shared.value)
            for batch in batches:
                held = batch.column("held")
                long = held.value_lengths().to_numpy(zero_copy_only=False)
                node, place = (batch.column(c).to_numpy() for c in ("node", "place"))
                entry = held.flatten()
                stats = np.stack([entry.field(name).to_numpy() for name in names], axis=1)
                numbers = np.arange(len(node))
                group = np.repeat(numbers, long)
                at = entry.field("key").to_numpy() - bins.offsets[place[group]]
                # The zero bin has what the others leave of the node.
                taken = np.stack([np.bincount(group, s, len(node)) for s in stats.T], axis=1)
                stats = np.concatenate([stats, known[node] - taken])
                group, at = np.append(group, numbers), np.append(at, bins.zero[place])
                order = np.lexsort((at, group))
                left, group, at = stats[order], group[order], at[order]
                first = np.searchsorted(group, numbers)
                for step in range(1, int(long.max()) + 1):
                    now = first[long >= step] + step
                    left[now] += left[now - 1]
                owner, column = node[group], place[group]
                right = known[owner] - left
                n_left, n_right = weight(left, classes), weight(right, classes)
                with np.errstate(divide="ignore", invalid="ignore"):
                    all_rows = n_left + n_right
                    gain = before[owner] - n_left / all_rows * impurity(left, classes)
                    gain = gain - n_right / all_rows * impurity(right, classes)
                fine = (at < bins.splits[column]) & (n_left >= 1) & (n_right >= 1) & (gain > 0)
                order = np.lexsort((at, column, -gain, owner))
                order = order[fine[order]]
                order = order[np.unique(owner[order], return_index=True)[1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": pa.array(owner[order]),
                        "gain": pa.array(gain[order]),
                        "place": pa.array(column[order]),
                        "split": pa.array(at[order]),
                        "left": pa.array(left[order].tolist(), pa.list_(pa.float64())),
                    }
                )

        lists = counts.groupBy("node", "place").agg(
            F.collect_list(F.struct("key", *names)).alias("held")
        )
        shape = "node long, gain double, place long, split long, left array<double>"
        judged = lists.mapInArrow(judge, shape)
        rank = F.struct(F.col("gain"), -F.col("place"), -F.col("split"))
        row = F.struct("gain", "place", "split", "left")
        return judged.groupBy("node").agg(F.max_by(row, rank).alias("best")).collect()

    def grow(self, number: int) -> list[Tree]:
        trees = [Tree() for _ in range(number)]
        width = self.classes or 3
        roots = self.counted(trees, [[0]] * number, totals=True).collect()
        stats = {r["node"]: np.array([r[f"s{i}"] for i in range(width)]) for r in roots}
        for i, tree in enumerate(trees):
            self.add(tree, stats.get(i, np.zeros(width)), 0)
        nodes = [[0] for _ in trees] if self.max_depth and len(self.bins.columns) else []
        depth = 0
        while any(nodes):
            depth += 1
            found = self.best(self.counted(trees, nodes, totals=False), trees, nodes)
            where = [(i, n) for i, open_ in enumerate(nodes) for n in open_]
            nodes = [[] for _ in trees]
            for row in sorted(found, key=lambda r: r["node"]):
                i, n = where[row["node"]]
                tree, split = trees[i], row["best"]
                left = np.array(split["left"])
                tree.column[n], tree.split[n] = split["place"], split["split"]
                tree.gain[n] = split["gain"]
                tree.left[n] = len(tree.column)
                for part in (left, tree.stats[n] - left):
                    child = self.add(tree, part, depth)
                    if depth < self.max_depth and abs(impurity(part, self.classes)) >= EPSILON:
                        nodes[i].append(child)
        return trees

    def add(self, tree: Tree, stats: np.ndarray, depth: int) -> int:
        empty = not weight(stats, self.classes)
        return tree.add(stats, depth, 0.0 if empty else prediction(stats, self.classes))


def column_mask(bins: Bins, columns: int, seed: int, tree: int, nodes: list[int]) -> np.ndarray:
    """Which columns each node may be split at: so many of all, with or without bins."""
    mask = np.zeros((len(nodes), len(bins.columns)), bool)
    place_of = np.full(bins.width, -1, np.int64)
    place_of[bins.columns] = np.arange(len(bins.columns))
    for i, node in enumerate(nodes):
        rng = np.random.default_rng([seed % 2**32, tree, node])
        places = place_of[rng.choice(bins.width, columns, replace=False, shuffle=False)]
        mask[i, places[places >= 0]] = True
    return mask


def node_rows(tree: Tree, bins: Bins, classes: int) -> list[tuple]:
    """The nodes as MLlib saves them, from the root down, left before right. Of a class tree, leaves
    side by side that say the same are one leaf."""
    alone = [c < 0 for c in tree.column]
    for n in range(len(alone) - 1, -1, -1):
        if not alone[n]:
            one = tree.left[n]
            if alone[one] and alone[one + 1] and tree.value[one] == tree.value[one + 1]:
                alone[n] = True
    rows: list[list] = []
    waiting = [(0, None, None)]
    while waiting:
        n, parent, side = waiting.pop()
        number = len(rows)
        if parent is not None:
            rows[parent][side] = number
        stats = tree.stats[n]
        row = [number, tree.value[n], float(impurity(stats, classes)), stats.tolist()]
        row += [int(weight(stats, classes)), -1.0, -1, -1, (-1, [], -1)]
        if not alone[n]:
            c = tree.column[n]
            threshold = float(bins.thresholds[bins.starts[c] + tree.split[n]])
            row[5], row[8] = tree.gain[n], (int(bins.columns[c]), [threshold], -1)
            waiting += [(tree.left[n] + 1, number, 7), (tree.left[n], number, 6)]
        rows.append(row)
    return [tuple(row) for row in rows]


def as_model(estimator: Estimator, rows: DataFrame, grown: list[list[tuple]], width: int, classes: int) -> Model:
    """The trees as the model that the estimator would have fitted.

    A model fitted on empty vectors is saved, its nodes replaced, and loaded again, as for the
    count vectorizer.
    """
    spark = rows.sparkSession
    empty = [(Vectors.sparse(width, [], []), float(c)) for c in range(classes or 1)] * 2
    names = [estimator.getOrDefault("featuresCol"), estimator.getOrDefault("labelCol")]
    model = estimator.fit(spark.createDataFrame(empty, names))
    path = scratch_path(spark, "tree-model")
    model.save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    nodes = grown[0]
    if "treeID" in schema.names:
        nodes = [(i, node) for i, tree in enumerate(grown) for node in tree]
    spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    loaded = type(model).load(path)
    if sum(len(tree) for tree in grown) != getattr(loaded, "totalNumNodes", None) and len(grown) > 1:
        raise RuntimeError("this version of Spark stores trees in another form")
    return loaded


def checked_classes(rows: DataFrame, label: str, classifier: bool) -> tuple[int, int]:
    """(rows, classes). Labels must be as MLlib wants them."""
    value = F.col(label)
    wrong = value.isNull() | F.isnan(value)
    if classifier:
        wrong = wrong | (value < 0) | (value != F.floor(value))
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong"), F.max(value).alias("most")
    ).first()
    if not found["n"]:
        raise ValueError("no rows to learn from")
    if found["wrong"]:
        raise ValueError(f"{found['wrong']} rows have a label that cannot be learned")
    classes = int(found["most"]) + 1 if classifier else 0
    if classes > MAX_CLASSES:
        raise ValueError(f"{classes} classes are more than {MAX_CLASSES}")
    return found["n"], classes


def fit_trees(estimator: Estimator, training: DataFrame, classifier: bool) -> Model:
    """What ``estimator.fit(training)`` stands for, for the tree estimators.

    ``training`` (vectors and labels) is read three times and should be a stored table.
    """
    vectors, label = (estimator.getOrDefault(c) for c in ("featuresCol", "labelCol"))
    first = training.select(vectors).first()
    if first is None or first[0] is None or first[0].size <= NARROW:
        return estimator.fit(training)
    setting = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.isDefined(p)}
    rows = training.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(label).cast("double").alias("target"),
        F.col(vectors).alias("features"),
    )
    total, classes = checked_classes(rows, "target", classifier)
    width, seed = first[0].size, setting["seed"]
    entries = entries_of(rows)
    bins = find_bins(entries, total, width, setting["maxBins"], seed)
    # Plain arrays, which need no package on the workers to be loaded.
    arrays = (width, bins.columns, bins.thresholds, bins.starts)
    shared = rows.sparkSession.sparkContext.broadcast(arrays)
    stored = materialize(binned(entries, shared), "binned-rows")
    number = setting.get("numTrees", 1)
    columns = width
    if number > 1:
        columns = math.ceil(math.sqrt(width) if classifier else width / 3.0)
    learner = Learner(
        stored, bins, shared, classes, setting["maxDepth"], seed,
        setting["maxMemoryInMB"] << 20, columns, number > 1,
    )
    if "stepSize" in setting:
        trees: list[Tree] = []
        for i in range(setting["maxIter"]):
            learner.before, learner.rates = trees, [1.0, *[setting["stepSize"]] * max(i - 1, 0)][:i]
            trees = trees + learner.grow(1)
    else:
        trees = learner.grow(number)
    grown = [node_rows(tree, bins, classes) for tree in trees]
    return as_model(estimator, rows, grown, width, classes)
