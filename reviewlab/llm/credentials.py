"""Secret scans that tell live-looking credentials from widely copied examples.

Candidates are found by fixed patterns. The hash of each candidate is counted over the whole
corpus by distinct owners and repositories, equal texts once: an opaque value that many share is an
example, one that few have looks live. Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import lower_bound, once, whole_text
from reviewlab.session import materialize

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIN_ASSIGNED = 12
KINDS = ("assign", "access", "hex")

#: Long runs without a known shape; kept only if they mix letters and digits and are not widely
#: copied.
OPAQUE = r"[A-Za-z0-9+/_-]{24,}"
#: Owners that may share a credential of a known shape that still counts as live.
MAX_OWNERS = 1
#: An opaque value is widely copied if more than so many owners or repositories have it, and more
#: than this percentage of all of them.
FEW = 3
WIDE_PERCENT = 1
#: Spans whose places are summed up together.
TOGETHER = 256


def spans(text: Column, kind: str, pattern: str) -> Column:
    """All matches with their places: array<struct<start, end, kind, match>>.

    SQL has no function that gives places, but the pieces between matches have lengths. Matches
    are leftmost and do not overlap; places are code points. Texts without a match, nearly all,
    cost one search.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,kind:string,match:string>>")
    start = lambda at: F.struct(at.alias("at"), empty.alias("found"))

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["before"]
        end = begin + F.length(pair["match"])
        span = F.struct(
            begin.alias("start"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            pair["match"].alias("match"),
        )
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(matches)),
        matches,
        lambda p, m: F.struct(F.length(p).alias("before"), m.alias("match")),
    )
    # Appending copies a list, so places are summed up in groups and then over the groups.
    grouped = lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p), F.lit(TOGETHER)), lambda i: F.slice(p, i, TOGETHER)
    )
    long = lambda g: F.aggregate(
        g, F.lit(0), lambda a, x: a + x["before"] + F.length(x["match"])
    )
    begins = lambda g: F.aggregate(
        g,
        F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + long(x))),
    )
    found = lambda g: F.flatten(
        F.zip_with(
            g,
            F.slice(begins(g), 1, F.size(g)),
            lambda x, at: F.aggregate(x, start(at), add, lambda acc: acc["found"]),
        )
    )
    return F.when(
        F.regexp_like(text, F.lit(pattern)), bound(bound(pairs, grouped), found)
    ).otherwise(empty)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def value(span: Column) -> Column:
    """The credential itself: of an assignment, what is assigned."""
    assigned = F.regexp_extract(span["match"], ASSIGN, 2)
    return F.when(span["kind"] == "assign", assigned).otherwise(span["match"])


def digest(found: Column) -> Column:
    """kind:start:end of all spans, by start and then by the order of kinds, comma-joined."""
    order = {"assign": 0, "access": 1, "hex": 2, "opaque": 3}
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    sortable = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.element_at(rank, s["kind"]).alias("rank"),
            F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ).alias("name"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(sortable), lambda s: s["name"]), ",")


def matching(kind: str) -> Callable[[Column], Column]:
    return lambda found: found == kind


def uncovered(base: str, more: str) -> Column:
    """The spans of ``more`` whose place no base span covers; those need a second opinion.

    Spans of one kind are in order and do not overlap, so of each kind only the last one that
    begins before a span's end can reach into it.
    """
    kinds = [(k, F.filter(base, matching_kind(k))) for k in KINDS]
    parts = F.struct(
        *[spans_.alias(k) for k, spans_ in kinds],
        *[spans_["start"].alias(f"{k}_starts") for k, spans_ in kinds],
    )

    def is_free(parts: Column, span: Column) -> Column:
        free = F.lit(True)
        for kind in KINDS:
            last = F.get(parts[kind], lower_bound(parts[f"{kind}_starts"], span["end"]) - 1)
            free = free & ~F.coalesce(last["end"] > span["start"], F.lit(False))
        return free

    left = bound(parts, lambda p: F.filter(more, lambda m: is_free(p, m)))
    return F.when((F.size(base) > 0) & (F.size(more) > 0), left).otherwise(F.col(more))


def matching_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def scan(docs: DataFrame, owner: Column, repo: Column, text: str = "text") -> DataFrame:
    """Per row doc_id, owner, repo, base and more (spans that need confirmation)."""
    row = docs.select(
        F.col("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
        F.monotonically_increasing_id().alias("rid"),
        F.xxhash64(whole_text(text)).alias("copy"),
        F.length(whole_text(text)).alias("n_chars"),
        whole_text(text).alias("body"),
    )
    body = F.col("body")
    base = F.concat(
        F.filter(
            spans(body, "assign", ASSIGN),
            lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= MIN_ASSIGNED,
        ),
        spans(body, "access", ACCESS),
        spans(body, "hex", HEX),
    )
    more = F.filter(
        spans(body, "opaque", OPAQUE),
        lambda s: F.regexp_like(s["match"], F.lit("[0-9]"))
        & F.regexp_like(s["match"], F.lit("[A-Za-z]")),
    )
    row = once(once(row, "base", base), "found", more)
    return row.select("*", uncovered("base", "found").alias("more")).drop("body", "found")


def independent(candidates: DataFrame) -> DataFrame:
    """Per value (sum): owners and repositories that have it, where equal whole texts count once,
    for the first of their owners. A text that is at least half the value is no document that was
    copied with it, and counts for each owner."""
    copied = candidates.where("not alone").groupBy("sum", "copy")
    first = copied.agg(F.min(F.struct("owner", "repo")).alias("first"))
    alone = candidates.where("alone").select("sum", "owner", "repo")
    return (
        first.select("sum", "first.owner", "first.repo")
        .unionByName(alone)
        .groupBy("sum", "owner", "repo")
        .agg(F.count("*").alias("n"))
        .groupBy("sum", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("sum")
        .agg(F.count("*").alias("free_owners"), F.sum("repos").alias("free_repos"))
    )


def widest(found: DataFrame) -> tuple[int, int]:
    """The most owners and the most repositories that may have an opaque value that is live."""
    pairs = found.groupBy("owner", "repo").agg(F.count("*").alias("n"))
    per_owner = pairs.groupBy("owner").agg(F.count("*").alias("repos"))
    owners, repos = per_owner.agg(F.count("*"), F.coalesce(F.sum("repos"), F.lit(0))).first()
    return max(FEW, owners * WIDE_PERCENT // 100), max(FEW, repos * WIDE_PERCENT // 100)


def find_secrets(
    docs: DataFrame,
    owner: Column | None = None,
    repo: Column | None = None,
    text: str = "text",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example.

    ``spans`` has all base spans and the opaque ones whose value is not widely copied, by owners
    and by repositories, where copies of one document count once. n_live and n_example count the
    row's candidates of either sort; those of base spans are live if at most ``max_owners`` owners
    have the value. A null text has no spans; null owners or repositories count as one more, empty
    name. Repeated rows are rows of their own but add no owner.

    Only candidates are shuffled. Owners are counted in steps (value and owner, then value), so a
    value in a third of all documents is one row per task; its many candidates take their count
    from a join that splits skewed keys.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    found = materialize(scan(docs, owner, repo, text), "secret-spans")
    candidates = (
        found.where("size(base) + size(more) > 0")
        .select(
            "rid", "owner", "repo", "copy", "n_chars",
            F.explode(F.concat("base", "more")).alias("span"),
        )
        .withColumn("sum", F.sha2(value(F.col("span")), 256))
        .withColumn("alone", F.length(value(F.col("span"))) * 2 >= F.col("n_chars"))
        .drop("n_chars")
    )
    spread = (
        candidates.groupBy("sum", "owner")
        .agg(F.count("*").alias("n"))
        .groupBy("sum")
        .agg(F.count("*").alias("owners"))
    )
    spread = materialize(spread.join(independent(candidates), "sum"), "secret-owners")
    most_owners, most_repos = widest(found)
    few = (F.col("free_owners") <= most_owners) & (F.col("free_repos") <= most_repos)
    live = F.when(F.col("span.kind") == "opaque", few).otherwise(F.col("owners") <= max_owners)
    confirmed = F.when(live & (F.col("span.kind") == "opaque"), F.col("span"))
    per_row = (
        candidates.join(spread, "sum")
        .groupBy("rid")
        .agg(
            F.collect_list(confirmed).alias("added"),
            F.sum(live.cast("long")).alias("n_live"),
            F.sum((~live).cast("long")).alias("n_example"),
        )
    )
    all_spans = F.concat("base", F.coalesce("added", F.array().cast(found.schema["base"].dataType)))
    counts = [
        F.size(F.filter("base.kind", matching(kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.join(per_row, "rid", "left").select(
        "doc_id",
        *counts,
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(all_spans).alias("spans"),
        F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
        F.coalesce("n_example", F.lit(0).cast("long")).alias("n_example"),
    )
