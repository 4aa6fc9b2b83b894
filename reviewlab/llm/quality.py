"""Quality rules whose cutoffs are certified on labelled documents.

Each rule has a score from 0 to 100 and rejects a document whose score reaches a cutoff. A cutoff
may be used in a stratum only if an exact binomial bound on labelled good documents shows that it
rejects at most a given share of them; the error level is divided by the number of cutoffs that
could be tried. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlab.llm.common import SPACE, once, packed, unpacked, whole_text, words_of
from reviewlab.session import materialize

#: Words in a window; a window found twice marks its words as repeated.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: Scores are whole per cents from 0 to this.
GRID = 100
RULES = ("symbols", "capitals", "dup_lines", "repeats")
#: Good documents that all rules together may reject, the level of error, and the price of one
#: good document in bad ones.
RISK = 0.04
LEVEL = 0.05
PRICE = 5

FEATURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_capitals",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


def kept_chars(text: Column, others: str) -> Column:
    """How many characters stay when those that match ``others`` are removed."""
    return F.length(F.regexp_replace(text, others, ""))


def measure(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Counts of every whole text beside its packed row (of the columns ``carry``, or all).

    Adds n_words, word_chars, n_symbols, n_capitals, n_lines (lines with a word), n_dup_lines and
    n_repeat_words. A null text counts as empty and gives zeros.

    Repeated windows: windows are hashed by doubling (1, 2, 4, 8 words). Only a text in which a
    hash is found twice compares its windows word by word, after sorting, so the work is
    n log n in the words also for texts that repeat everything.
    """
    df = packed(docs, carry, text=whole_text(text))
    df = once(df, "words", words_of(F.col("text")))
    df = once(
        df,
        "lines",
        F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACE, "")) > 0),
    )
    df = df.select(
        "row",
        "words",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        kept_chars(F.col("text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        kept_chars(F.col("text"), r"[^A-ZÀ-ÖØ-Þ]+").alias("n_capitals"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    )
    df = once(df, "p1", F.transform("words", lambda word: F.xxhash64(word)))
    n = F.col("n_words")
    for step, name, before in ((1, "p2", "p1"), (2, "p4", "p2"), (4, "p8", "p4")):
        rest = F.slice(before, step + 1, F.greatest(n, F.lit(1)))
        df = once(df, name, F.zip_with(before, rest, lambda a, b: F.xxhash64(a, b))).drop(before)
    windows = F.slice("p8", 1, F.greatest(n - (WINDOW - 1), F.lit(0)))
    df = once(df, "hashes", windows).drop("p8")
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    df = once(df, "found", F.when(repeated, sorted_windows(F.col("words"), n)))
    covered = F.coalesce(covered_words(F.col("found")), F.lit(0))
    return df.select(
        "row",
        *[F.col(c).cast("long") for c in FEATURES[:-1]],
        covered.cast("long").alias("n_repeat_words"),
    )


def sorted_windows(words: Column, n: Column) -> Column:
    """Every window with its place, equal windows side by side."""
    window = lambda i: F.array_join(F.slice(words, i, WINDOW), " ")
    places = F.sequence(F.lit(1), n - (WINDOW - 1))
    return F.sort_array(
        F.transform(places, lambda i: F.struct(window(i).alias("w"), i.alias("i")))
    )


def covered_words(found: Column) -> Column:
    """Words inside windows that have an equal one; null where there is no list."""
    pairs = F.zip_with(
        found,
        F.slice(found, 2, F.greatest(F.size(found), F.lit(1))),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(
            F.array().cast("array<int>")
        ),
    )
    places = F.sort_array(F.array_distinct(F.flatten(pairs)))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    return F.aggregate(
        places,
        start,
        lambda acc, i: F.struct(
            (acc["total"] + WINDOW - F.greatest(acc["end"] - i, F.lit(0))).alias("total"),
            (i + WINDOW).alias("end"),
        ),
        lambda acc: acc["total"],
    )


def base_failed() -> Column:
    too_short = F.col("n_words") < MIN_WORDS
    return too_short | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def share(part: str, whole: str) -> Column:
    """Per cent in whole numbers, at most GRID; 0 of nothing is 0."""
    percent = F.expr(f"({GRID} * {part}) div greatest({whole}, 1)")
    return F.least(percent, F.lit(GRID)).cast("int")


def scores() -> dict[str, Column]:
    return {
        "symbols": share("n_symbols", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def log_binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Bin(n, p), summed term by term in logarithms."""
    from math import log, log1p

    first = n * F.lit(log1p(-p))
    odds = log(p) - log1p(-p)

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(acc["sum"], term), F.least(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    start = F.struct(first.alias("term"), first.alias("sum"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(steps, start, add, lambda acc: acc["sum"])


def certify(
    labelled: DataFrame, risk: float = RISK, level: float = LEVEL, price: int = PRICE
) -> DataFrame:
    """One row per stratum and rule that has a certified cutoff: stratum, rule, cutoff, n_good,
    n_false, n_caught.

    ``labelled`` has stratum, good (boolean) and a column per rule. A cutoff is certified if
    P(Bin(n_good, risk / rules) <= n_false) is at most level / (strata x rules x GRID), which
    means that the upper Clopper-Pearson bound on its false rejections is below the risk. Of the
    certified ones the rule takes that with the most (caught - price x false), the higher on a
    tie, and none if that is not positive. Strata with few labels certify nothing.
    """
    names = ", ".join(f"'{r}', {r}" for r in RULES)
    long = labelled.select(
        "stratum", "good", F.expr(f"stack({len(RULES)}, {names}) as (rule, score)")
    )
    counts = long.groupBy("stratum", "rule", "score").agg(
        F.sum(F.col("good").cast("long")).alias("good"),
        F.sum((~F.col("good")).cast("long")).alias("bad"),
    )
    counts = materialize(counts, "rule-counts")
    strata = counts.select("stratum").distinct().count()
    tests = max(1, strata) * len(RULES) * GRID
    group = Window.partitionBy("stratum", "rule")
    above = group.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    tried = counts.select(
        "stratum",
        "rule",
        F.col("score").alias("cutoff"),
        F.sum("good").over(group).alias("n_good"),
        F.sum("good").over(above).alias("n_false"),
        F.sum("bad").over(above).alias("n_caught"),
    ).where("cutoff > 0")
    p = risk / len(RULES)
    bound = F.when(
        F.col("n_false") <= F.lit(p) * F.col("n_good"),
        log_binomial_cdf(F.col("n_good"), F.col("n_false"), p) <= F.log(F.lit(level / tests)),
    )
    gain = F.col("n_caught") - price * F.col("n_false")
    best = (
        tried.where(bound)
        .withColumn("gain", gain)
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct("gain", "cutoff", "n_good", "n_false", "n_caught")).alias("best"))
    )
    return best.select(
        "stratum", "rule", *[f"best.{c}" for c in ("cutoff", "n_good", "n_false", "n_caught")]
    )


def verdicts(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    text: str = "text",
    carry: list[str] | None = None,
    **control,
) -> DataFrame:
    """Every row of ``docs`` packed as ``row`` with its counts, base_failed and kept.

    ``labels`` has doc_id and quality (1: good, 0: bad). Labels without an id or a quality are
    not used; a document labelled twice is good only if all its labels say so; documents that
    share a doc_id count once each. A null stratum is a stratum of its own. Without labels, or
    with too few, no rule has a cutoff and only the base rules reject. An empty table gives an
    empty result. All labelled documents are counted, at every size.
    """
    measured = materialize(measure(docs, text, carry), "measured")
    measured = measured.withColumn("stratum", F.col("row").getField(stratum).cast("string"))
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
    )
    labelled = (
        measured.select(
            F.col("row.doc_id").alias("doc_id"),
            "stratum",
            *[s.alias(r) for r, s in scores().items()],
        )
        .join(known, "doc_id")
        .drop("doc_id")
    )
    cutoffs = materialize(certify(labelled, **control), "cutoffs")
    per_stratum = cutoffs.groupBy(F.col("stratum").alias("of")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]
    )
    judged = measured.join(per_stratum, F.col("stratum").eqNullSafe(F.col("of")), "left")
    rejected = F.lit(False)
    for rule, score in scores().items():
        rejected = rejected | F.coalesce(score >= F.col(f"cut_{rule}"), F.lit(False))
    return judged.select(
        "row",
        *FEATURES,
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that the rules keep, with their columns as they were."""
    judged = verdicts(docs, labels, **options).where("kept")
    return judged.select(*unpacked(docs.columns))


