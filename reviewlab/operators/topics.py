"""Topics of the review texts.

MLlib's learner finds the topic shares of each review by steps that creep up on their fixed point, more than
a thousand of them in the first iteration. Here the steps of many reviews are taken at once and
extrapolated, with MLlib's stop rule; start, updates and settings of the topics are MLlib's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from reviewlab.operators.features import counted_words, weighted
from reviewlab.operators.trees import entries_of
from reviewlab.session import materialize

# Number of topics, iterations, and words that describe a topic.
TOPICS = 10
ITERATIONS = 10
TERMS_PER_TOPIC = 10
SEED = 42

#: A review's shares are found when a step changes its topic weights by no more than this on average.
TOLERANCE = 1e-3
#: Steps before the first extrapolation, which keeps to the fixed point that plain steps lead to.
PLAIN_STEPS = 10
#: Entries, with those that fill up shorter reviews, of the reviews that are solved at once.
BLOCK_ENTRIES = 32_000
#: Entries that are added to a task's sums together.
FLUSHED_ENTRIES = 1_000_000
#: Sums travel as whole multiples of its inverse, so the order of tasks does not change them.
SCALE = float(1 << 24)


def fit_topics(
    cleaned: DataFrame,
    vocabulary_size: int,
    k: int = TOPICS,
    iterations: int = ITERATIONS,
    terms_per_topic: int = TERMS_PER_TOPIC,
    seed: int = SEED,
    share_per_iteration: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """``topic, termIndices, termWeights`` of each topic, and the vocabulary table.

    ``share_per_iteration`` of the reviews are drawn for every iteration. The default reads all
    of them every time, which costs a full pass per iteration; Spark's own default of 5 % leaves
    most reviews unread within ten iterations.
    """
    counted, terms = counted_words(cleaned.select("cleaned_review"), vocabulary_size)
    # IDF reads the counts once more; its result is stored for the iterations.
    counted = counted.select("rawFeatures").persist(StorageLevel.MEMORY_AND_DISK)
    corpus = weighted(counted)
    first = corpus.first()
    if first is None:
        raise ValueError("no reviews to learn from")
    entries = materialize(entries_of(corpus), "topic-entries")
    counted.unpersist()
    lda = LDA(k=k, maxIter=iterations, seed=seed, subsamplingRate=share_per_iteration)
    topics = learned_topics(entries, lda, first["features"].size)
    most = min(terms_per_topic, topics.shape[0])
    rows = []
    for topic, weights in enumerate((topics / topics.sum(axis=0)).T):
        best = np.argsort(-weights, kind="stable")[:most]
        rows.append((topic, best.tolist(), weights[best].tolist()))
    shape = "topic int, termIndices array<int>, termWeights array<double>"
    return cleaned.sparkSession.createDataFrame(rows, shape).coalesce(1), terms


def learned_topics(entries: DataFrame, lda: LDA, width: int) -> np.ndarray:
    """Term by topic: what ``lda.fit`` learns online from ``columns, amounts`` of each review.

    The driver and every task hold the table of terms by topics, as MLlib's do; the vocabulary bounds it.
    """
    spark = entries.sparkSession
    k, share = lda.getK(), lda.getSubsamplingRate()
    start = lda.copy({lda.maxIter: 0, lda.subsamplingRate: 1.0})
    # The start is drawn before any review is read, so MLlib gives it for a corpus without words.
    nothing = spark.createDataFrame([(Vectors.sparse(width, [], []),)], ["features"])
    topics = start.fit(nothing).topicsMatrix().toArray().reshape(width, k)
    alpha, eta = np.full(k, 1.0 / k), 1.0 / k
    reviews = entries.count()
    for number in range(1, lda.getMaxIter() + 1):
        drawn = entries if share >= 1 else entries.sample(True, share, lda.getSeed() + number)
        factors = np.exp(expectation(topics.T)).T.copy()
        shared = spark.sparkContext.broadcast((factors, alpha))
        term, n, sums = summed(drawn, shared, k)
        shared.destroy()
        totals = term < 0
        used = int(n[totals].sum())
        if not used:
            continue
        step = (lda.getLearningOffset() + number) ** -lda.getLearningDecay()
        found = np.zeros((width, k))
        found[term[~totals]] = sums[~totals]
        topics = (1 - step) * topics + step * (found * (reviews / used) + eta)
        if lda.getOptimizeDocConcentration():
            alpha = next_alpha(alpha, sums[totals].sum(axis=0) / used, used, step)
    return topics


def summed(entries: DataFrame, shared, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected occurrences of each term by topic; under term -1 the number of reviews and the sums of the
    expected logarithms of their shares."""
    names = [f"s{i}" for i in range(k)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, alpha = shared.value
        found, logs, n = np.zeros(factors.shape[::-1]), np.zeros(k), 0
        for places, parts, share in flushed(batches, factors, alpha):
            logs, n = logs + share.sum(axis=0), n + len(share)
            for topic in range(k):
                found[topic] += np.bincount(places, parts[topic], len(factors))
        if n:
            term = np.flatnonzero(found.any(axis=0))
            sums = np.rint(np.concatenate([logs[:, None], found[:, term]], axis=1) * SCALE)
            made = {"term": np.append(-1, term), "n": np.append(n, 0 * term)}
            made |= dict(zip(names, sums.astype(np.int64)))
            yield pa.RecordBatch.from_pydict({name: pa.array(v) for name, v in made.items()})

    shape = ", ".join(f"{name} long" for name in ("term", "n", *names))
    rows = entries.mapInArrow(count, shape).groupBy("term").agg(
        *[F.sum(name).alias(name) for name in ("n", *names)]
    )
    table = rows.toArrow()
    sums = [table.column(name).to_numpy() / SCALE for name in names]
    return table.column("term").to_numpy(), table.column("n").to_numpy(), np.stack(sums, axis=1)


def flushed(
    batches: Iterator[pa.RecordBatch], factors: np.ndarray, alpha: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Terms with their expected occurrences (topic by term), and the expected logarithms of the reviews'
    shares, of many reviews together."""
    held, size = [], 0
    for batch in batches:
        for ids, amounts in blocks_of(batch):
            weights = np.ascontiguousarray(factors[ids].transpose(0, 2, 1))
            logs = expectation(review_weights(weights, amounts, alpha))
            share = np.exp(logs)
            ratio = amounts / (np.matmul(share[:, None], weights)[:, 0] + 1e-100)
            used = amounts > 0
            parts = (weights * share[:, :, None] * ratio[:, None]).transpose(1, 0, 2)[:, used]
            held.append((ids[used], parts, logs))
            size += parts.shape[1]
            if size >= FLUSHED_ENTRIES:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    places, parts, logs = zip(*held)
    return np.concatenate(places), np.concatenate(parts, axis=1), np.concatenate(logs)


def blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms and amounts of reviews of similar length, one row each, filled up with amounts of zero.
    Reviews without a term are left out."""
    lists = batch.column("columns")
    long = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    amounts = batch.column("amounts").flatten().to_numpy(zero_copy_only=False)
    filled = np.add.reduceat(np.append(amounts > 0, False), np.cumsum(long) - long) if len(long) else long
    begins = np.cumsum(long) - long
    order = np.argsort(long, kind="stable")
    order = order[(long[order] > 0) & (filled[order] > 0)]
    at = 0
    while at < len(order):
        most = long[order[at:]]
        fit = most * np.arange(1, len(most) + 1) <= BLOCK_ENTRIES
        size = max(1, int(fit.sum()))
        rows, width = order[at : at + size], most[size - 1]
        place = np.arange(width)
        held = place < long[rows][:, None]
        index = np.where(held, begins[rows][:, None] + place, begins[rows][:, None])
        yield ids[index], np.where(held, amounts[index], 0.0)
        at += size


def review_weights(weights: np.ndarray, amounts: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """The topic weights of each review, from the factors of its terms (review by topic by term).

    Two plain steps tell their direction and how it bends; the third starts where these lead to
    (the scheme SQUAREM). How far it may leap grows only as it succeeds.
    """

    def step(gamma: np.ndarray) -> np.ndarray:
        share = np.exp(expectation(gamma))
        norm = np.matmul(share[:, None], weights)[:, 0] + 1e-100
        return share * np.matmul(weights, (amounts / norm)[:, :, None])[:, :, 0] + alpha

    found = np.ones((len(amounts), len(alpha)))
    gamma, live, leap = found, np.arange(len(amounts)), np.full((len(amounts), 1), 4.0)
    for _ in range(PLAIN_STEPS):
        gamma = step(gamma)
    while True:
        first = step(gamma)
        second = step(first)
        going = np.abs(second - first).mean(axis=1) > TOLERANCE
        if not going.all():
            found[live[~going]] = second[~going]
            if not going.any():
                return found
            parts = (live, weights, amounts, gamma, first, second, leap)
            live, weights, amounts, gamma, first, second, leap = (a[going] for a in parts)
        moved = first - gamma
        bend = second - first - moved
        far = np.sqrt((moved**2).sum(axis=1) / np.maximum((bend**2).sum(axis=1), 1e-300))[:, None]
        leap, far = np.where(far >= leap, 4 * leap, leap), np.clip(far, 1.0, leap)
        gamma = step(np.maximum(gamma + 2 * far * moved + far * far * bend, alpha))


def expectation(gamma: np.ndarray) -> np.ndarray:
    """Expected logarithms of shares with Dirichlet's distribution, one row each."""
    return digamma(gamma) - digamma(gamma.sum(axis=-1, keepdims=True))


def digamma(x: np.ndarray) -> np.ndarray:
    """By its series for large numbers, six above x."""
    below = sum(1.0 / (x + i) for i in range(6))
    y = x + 6.0
    f = 1.0 / (y * y)
    rest = f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))
    return np.log(y) - 0.5 / y - rest - below


def trigamma(x: np.ndarray) -> np.ndarray:
    below = sum(1.0 / (x + i) ** 2 for i in range(6))
    y = x + 6.0
    f = 1.0 / (y * y)
    rest = f / y * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f * (1 / 30 - f * 5 / 66))))
    return 1.0 / y + 0.5 * f + rest + below


def next_alpha(alpha: np.ndarray, logs: np.ndarray, n: int, step: float) -> np.ndarray:
    """One Newton step of the reviews' concentration, unless it would leave the positive numbers."""
    slope = n * (logs - expectation(alpha))
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1.0 / c + (1.0 / q).sum())
    moved = alpha - step * (slope - b) / q
    return moved if (moved > 0).all() else alpha


def topic_terms(topics: DataFrame, terms: DataFrame) -> DataFrame:
    """``topic, rank, word, weight``: the topics with their words spelled out.

    The topic side is broadcast: it has k times terms_per_topic rows, whatever the corpus.
    """
    exploded = topics.select(
        "topic",
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "entry"),
    ).select(
        "topic",
        "rank",
        F.col("entry.termIndices").alias("term"),
        F.col("entry.termWeights").alias("weight"),
    )
    return terms.join(F.broadcast(exploded), "term").select("topic", "rank", "word", "weight")


def topic_lines(spelled: DataFrame) -> DataFrame:
    """One line per topic: ``Topic 0: word(weight) word(weight) ...``."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "word", "weight")))
    words = F.transform(
        entries, lambda e: F.concat(e["word"], F.lit("("), e["weight"].cast("string"), F.lit(")"))
    )
    line = F.concat(
        F.lit("Topic "), F.col("topic").cast("string"), F.lit(": "), F.array_join(words, " ")
    )
    return spelled.groupBy("topic").agg(line.alias("TopicDetails")).orderBy("topic").drop("topic")
