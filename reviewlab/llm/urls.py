"""URL filters: explicit rules, and per host a tree of path templates learned from labels.

In every host the segments of paths form a tree. Segments that vary are generalised into
wildcards, branches whose labels do not differ from those of their siblings are merged, and a
template is rejected if the smoothed share of bad labels below it is too high. Everything is a
DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import ascii_lower, packed
from reviewlab.session import materialize

#: Explicit rules: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A literal branch has at least this many urls.
MIN_URLS = 3
#: Of the SQL alone, which checks the given tables: levels of its tree, and the share of its
#: parent's urls that a literal branch has there.
DEPTH = 6
MIN_PERCENT = 2
#: Branches differ if the square of the two-proportion z exceeds this (95 %).
Z_SQUARE = 3.84
#: Labels that a prior counts for, labels a rejected template has at least, and its purity.
SMOOTHING = 10.0
MIN_LABELS = 5
MIN_PURITY = 0.5

#: Host and path of a url.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> dict[str, Column]:
    """host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower case; path: from
    there up to ``?``, ``#`` or the end. Both are empty without ``://`` and for null."""
    url = F.coalesce(url, F.lit(""))
    return {
        "host": ascii_lower(F.regexp_extract(url, PARTS, 1)),
        "path": F.regexp_extract(url, PARTS, 2),
    }


def longest_rule(rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for said, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = fits & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """The path with every run of digits as ``#`` and without empty segments."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.regexp_replace(F.array_join(segments, "/"), "[0-9]+", "#")


def one_level(tree: DataFrame, level: int) -> DataFrame:
    """Extend every template by its segment at this level: the literal, or a wildcard.

    A segment stays literal if the share of bad labels below it differs from that of its siblings,
    however many those are; all others become one wildcard branch.
    """
    at = tree.withColumn("segment", F.get("segments", F.lit(level)))
    counts = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    child = at.where("segment is not null").groupBy("host", "template", "segment").agg(*counts)
    parent = child.groupBy("host", "template").agg(
        *[F.sum(c).cast("double").alias(f"all_{c}") for c in ("labelled", "bad")]
    )
    n, few, bad = (F.col(c).cast("double") for c in ("n", "labelled", "bad"))
    every, all_bad = F.col("all_labelled"), F.col("all_bad")
    gap = bad * (every - few) - (all_bad - bad) * few
    differs = gap * gap * every > F.lit(Z_SQUARE) * few * (every - few) * all_bad * (
        every - all_bad
    )
    literal = (n >= MIN_URLS) & differs
    branch = child.join(parent, ["host", "template"]).select(
        "host", "template", "segment", F.when(literal, F.col("segment")).alias("literal")
    )
    segment = F.concat(F.lit("/"), F.coalesce("literal", F.lit("*")))
    extended = F.when(F.col("segment").isNull(), F.col("template")).otherwise(
        F.concat("template", segment)
    )
    return at.join(branch, ["host", "template", "segment"], "left").select(
        "host", "shape", "segments", "n", "labelled", "bad", extended.alias("template")
    )


def next_split(tree: DataFrame, level: int) -> int | None:
    """The first level from this one on where a template can be split; None if there is none.

    A template can be split as long as paths below it part and have labels of both kinds. Where
    they part tells the first and the last of their remaining segments in order.
    """
    rest = F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0)))
    groups = (
        tree.where(F.size("segments") > level)
        .groupBy("host", "template")
        .agg(
            F.min(rest).alias("low"),
            F.max(rest).alias("high"),
            *[F.sum(c).alias(c) for c in ("labelled", "bad")],
        )
        .where("low <> high and bad > 0 and bad < labelled")
    )
    both = F.arrays_zip("low", "high")
    parts = F.array_position(F.transform(both, lambda p: ~p["low"].eqNullSafe(p["high"])), True)
    first = groups.agg(F.min(parts)).first()[0]
    return None if first is None else level + int(first) - 1


def wildcards(tree: DataFrame, level: int, to: int | None) -> DataFrame:
    """Extend every template by a wildcard for each of its segments from ``level`` up to ``to``."""
    stop = F.size("segments") if to is None else F.least(F.size("segments"), F.lit(to))
    more = F.repeat(F.lit("/*"), F.greatest(stop - level, F.lit(0)))
    return tree.withColumn("template", F.concat("template", more))


def judge_templates(urls: DataFrame) -> DataFrame:
    """Per host and shape: template, labels below the template, smoothed purity, rejected.

    ``urls`` has host, shape and bad (null where there is no label). The purity of a template is
    smoothed towards that of its host, and that towards the overall share. A host with a third of
    all urls is counted before the shuffle; what is joined later has a row per distinct shape.
    """
    tree = (
        urls.groupBy("host", "shape")
        .agg(
            F.count("*").alias("n"),
            F.count("bad").alias("labelled"),
            F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0).cast("long")).alias("bad"),
        )
        .select(
            "*",
            F.filter(F.split("shape", "/"), lambda s: s != "").alias("segments"),
            F.lit("").alias("template"),
        )
    )
    tree = materialize(tree, "url-shapes")
    level = 0
    while (split := next_split(tree, level)) is not None:
        tree = materialize(one_level(wildcards(tree, level, split), split), "url-tree")
        level = split + 1
    tree = wildcards(tree, level, None)
    total = tree.agg(F.sum("bad"), F.sum("labelled")).first()
    overall = float(total[0] or 0) / max(float(total[1] or 0), 1.0)
    sums = [F.sum(c).cast("double").alias(f"t_{c}") for c in ("labelled", "bad")]
    hosts = tree.groupBy("host").agg(
        *[F.sum(c).cast("double").alias(f"h_{c}") for c in ("labelled", "bad")]
    )
    prior = (F.col("h_bad") + SMOOTHING * F.lit(overall)) / (F.col("h_labelled") + SMOOTHING)
    purity = (F.col("t_bad") + SMOOTHING * prior) / (F.col("t_labelled") + SMOOTHING)
    templates = (
        tree.groupBy("host", "template")
        .agg(*sums)
        .join(hosts, "host")
        .select(
            "host",
            "template",
            F.col("t_labelled").cast("long").alias("n_labels"),
            F.round(purity, 6).alias("purity"),
        )
    )
    rejected = (F.col("n_labels") >= MIN_LABELS) & (F.col("purity") >= MIN_PURITY)
    return tree.join(templates, ["host", "template"]).select(
        "host", "shape", "template", "n_labels", "purity", rejected.alias("rejected")
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, template, n_labels, purity.

    ``labels`` has page_id and bad (boolean); rows with a null in either are not used, and a page
    labelled twice is bad if any label says so. An explicit rule decides first, else the page is
    blocked if its template is rejected. Urls that are null, empty or no urls form the template of
    the empty host. Repeated rows are judged each; without labels no template is rejected.
    """
    name, verdict = longest_rule(rules)
    urls = packed(pages, ["page_id"], **url_parts(F.col("url"))).select(
        F.col("row.page_id").alias("page_id"), "host", "path"
    )
    urls = urls.select(
        "*", name.alias("rule"), verdict.alias("said"), shape(F.col("path")).alias("shape")
    )
    urls = materialize(urls, "url-parts")
    known = (
        labels.where("page_id is not null and bad is not null")
        .groupBy(F.col("page_id").alias("of"))
        .agg(F.max("bad").alias("bad"))
    )
    judged = materialize(
        judge_templates(urls.join(known, F.col("page_id") == F.col("of"), "left")), "url-verdicts"
    )
    learned = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(judged, ["host", "shape"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", learned).alias("verdict"),
        "template",
        "n_labels",
        "purity",
    )
