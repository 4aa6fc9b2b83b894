"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines decides where a chunk of lines ends, so a
passage that moved to another place in another text is cut at the same lines. Very long lines are
passages, and chunks, by themselves. Chunks of several lines, or of one such line, that occur more than once in the corpus are removed but for their first occurrence, after
their bytes were compared. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import SPACE, is_among, lower_bound, once, packed, words_of
from reviewlab.session import materialize

#: A chunk ends where the rolling hash is divisible by this and was not one line before, so only
#: the ends of a text make chunks of one line.
DIVISOR = 2
#: (Chunks have four lines on average.) Weight of the line before in the rolling hash over two lines.
WEIGHT = 31
#: Characters of a line that is a chunk of its own: some 50 words.
LONG_LINE = 300
#: Words that a run of whole lines has more of to be a passage.
PASSAGE_WORDS = 50
#: Stands for a null doc_id, which sorts last.
NO_ID = 2**63 - 1


def line_hash(line: Column) -> Column:
    """28 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_lines and chunks: array<struct<first, last, body, key>> of the whole text, in order.

    ``key`` is null for chunks that are never removed: blank ones, and single lines that are not
    long.
    """
    df = once(df, "lines", F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")))
    df = once(df, "hashes", F.transform("lines", line_hash))
    n = F.size("lines")
    before = F.concat(F.array(F.lit(0).cast("long")), F.col("hashes"))
    rolled = F.zip_with(
        "hashes", F.slice(before, 1, n), lambda here, above: (here + WEIGHT * above) % DIVISOR
    )
    df = once(df, "rolled", rolled)
    above = lambda i: F.coalesce(F.get("rolled", i - 1), F.lit(1))
    is_long = lambda i: F.coalesce(F.length(F.get("lines", i)) >= LONG_LINE, F.lit(False))
    ends_here = lambda r, i: ((r == 0) & (above(i) != 0)) | is_long(i) | is_long(i + 1)
    last = F.filter(
        F.transform("rolled", lambda r, i: F.when(ends_here(r, i) | (i == n - 1), i + 1)),
        lambda i: i.isNotNull(),
    )
    df = once(df, "ends", last)
    starts = F.slice(F.concat(F.array(F.lit(0)), F.col("ends")), 1, F.size("ends"))
    bodies = F.zip_with(
        starts,
        "ends",
        lambda above, end: F.struct(
            (above + 1).alias("first"),
            end.alias("last"),
            F.array_join(F.slice("lines", above + 1, end - above), "\n").alias("body"),
        ),
    )
    df = once(df, "bodies", bodies)
    chunks = F.transform(
        "bodies",
        lambda c: F.struct(
            c["first"],
            c["last"],
            c["body"],
            F.when(
                ((c["last"] > c["first"]) | (F.length(c["body"]) >= LONG_LINE))
                & (F.length(F.translate(c["body"], SPACE, "")) > 0),
                F.xxhash64(c["body"]),
            ).alias("key"),
        ),
    )
    df = df.select("*", F.size("lines").alias("n_lines")).drop("lines", "hashes", "rolled", "ends")
    return once(df, "chunks", chunks).drop("bodies")


def drop_repeated(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    gone: DataFrame | None = None,
) -> DataFrame:
    """Every row packed as ``row``, with its text without repeated chunks.

    Columns: doc_id, row (unless ``carry`` is empty), text, n_lines, n_removed_lines, n_chunks,
    n_removed_chunks. Of equal chunks the
    one in the smallest doc_id stays, the first one in that text. Rows that share a doc_id count
    as one document (each keeps what the document keeps); a null doc_id counts as the largest. A
    null text stays null, without lines; a text may become empty. Rows are never dropped.
    The lines of ``gone`` (see ``passage_lines``) are left out of the texts, too; the counts are
    those of chunks alone.

    Only hashes are shuffled to find repeated keys. Whether a document holds the first occurrence
    is asked by (document, key), which no group of copies makes hot. Bytes are compared by
    grouping the bodies of the keys found twice; equal ones meet before the shuffle. Both joins
    with the texts read one exchange: a text and its row travel as one value, of which the
    optimizer cannot leave out a part for one of them.
    """
    keys = {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "text": F.col(text)}
    texts = docs.select(*[value.alias(name) for name, value in keys.items()])
    base = texts if carry == [] else packed(docs, carry, **keys)
    parts = [c for c in base.columns if c != "doc"]
    base = base.select("doc", F.array(F.struct(*parts)).alias("held"))
    opened = [F.element_at("held", 1)[c].alias(c) for c in parts]
    counted = with_chunks(texts).select(
        "doc", F.explode("chunks.key").alias("key")
    )
    counted = materialize(
        counted.where("key is not null").groupBy("doc", "key").count(), "chunk-keys"
    )
    first = counted.groupBy("key").agg(
        F.min("doc").alias("doc"), (F.sum("count") > 1).alias("repeated")
    )
    # A key whose first document is another one is repeated; else its group says so.
    suspects = (
        counted.join(first, ["doc", "key"], "left")
        .where(F.coalesce("repeated", F.lit(True)))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list("key")).alias("suspects"))
    )
    joined = base.join(suspects, "doc", "left")
    suspected = joined.where("suspects is not null")
    bodies = with_chunks(suspected.select("doc", "suspects", *opened)).select(
        "doc",
        F.explode(
            F.filter("chunks", lambda c: is_among(F.col("suspects"), c["key"]))
        ).alias("chunk"),
    )
    kept = (
        bodies.groupBy(F.col("chunk.key").alias("key"), F.col("chunk.body").alias("body"))
        .agg(F.min("doc").alias("doc"))
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.md5("body"))).alias("kept"))
    )
    whole = joined.join(kept, "doc", "left")
    lines_gone = F.lit(None).cast("array<int>")
    if gone is not None:
        # By document alone, as the texts are; rows that share a doc_id are told apart by copy.
        per_doc = gone.groupBy("doc").agg(F.collect_list(F.struct("copy", "gone")).alias("gone"))
        whole = whole.join(per_doc, "doc", "left")
        copy = F.xxhash64(F.element_at("held", 1)["text"])
        lines_gone = F.get(F.filter("gone", lambda g: g["copy"] == copy), 0)["gone"]
    whole = whole.select("doc", "suspects", "kept", lines_gone.alias("gone"), *opened)
    whole = with_chunks(whole)
    whole = once(
        whole,
        "marked",
        F.transform(
            "chunks",
            lambda c: F.struct(
                *[c[f] for f in ("first", "last", "body")],
                F.when(is_among(F.col("suspects"), c["key"]), F.md5(c["body"])).alias("sum"),
            ),
        ),
    ).drop("chunks")
    sums = F.transform("marked", lambda c, i: F.struct(c["sum"].alias("sum"), i.alias("at")))
    whole = once(whole, "sums", F.array_sort(F.filter(sums, lambda s: s["sum"].isNotNull())))
    first_of = lambda sum_: F.get(
        "sums", lower_bound(F.col("sums"), F.struct(sum_.alias("sum"), F.lit(0).alias("at")))
    )
    # A suspect stays if this document keeps it and it is the first of its kind in the text.
    stays = F.transform(
        "marked",
        lambda c, i: c["sum"].isNull()
        | (is_among(F.col("kept"), c["sum"]) & (first_of(c["sum"])["at"] == i)),
    )
    whole = once(whole, "stays", stays)
    left = F.filter("marked", lambda c, i: F.get("stays", i))
    whole = once(whole, "left", left)
    lines = F.aggregate("left", F.lit(0), lambda a, c: a + c["last"] - c["first"] + 1)
    rows = ["row"] if "row" in whole.columns else []
    short = F.array_join("left.body", "\n")
    if gone is not None:
        places = F.flatten(F.transform("left", lambda c: F.sequence(c["first"] - 1, c["last"] - 1)))
        fewer = lambda all_: F.array_join(
            F.transform(F.array_except(places, "gone"), lambda i: F.get(all_, i)), "\n"
        )
        shorter = F.element_at(F.transform(F.array(F.split("text", "\n")), fewer), 1)
        short = F.when(F.col("gone").isNull(), short).otherwise(shorter)
    return whole.select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"),
        *rows,
        F.when(F.col("text").isNotNull(), short).alias("text"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - lines).cast("long").alias("n_removed_lines"),
        F.size("marked").cast("long").alias("n_chunks"),
        (F.size("marked") - F.size("left")).cast("long").alias("n_removed_chunks"),
    )


def without_repeated(docs: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """The documents with shortened texts; a column n_chars follows the new text.

    With ``gone`` from ``passage_lines`` of the same documents, repeated passages and repeated
    chunks go together: of either the first occurrence stays, unless it lies in a larger one that
    came still earlier. The texts are shuffled once for both.
    """
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.length("text"), F.lit(0)).cast(kind)
    columns = [new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    # The row need not carry the old text beside the one that is worked on.
    others = [c for c in docs.columns if c not in new]
    return drop_repeated(docs, carry=others, gone=gone).select(*columns)


def with_words(docs: DataFrame) -> DataFrame:
    """The documents that still have a word; the others were copies, line by line, of earlier ones."""
    return docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def passages(text: Column) -> Column:
    """array<struct<first, last, sum>>: the shortest passages that begin, and that end, at a line.

    Lines without words are passed over, so a passage has at most PASSAGE_WORDS + 1 lines. Every
    run of whole lines with more words than that is covered by the passages inside it.
    """
    lines = F.transform(
        F.split(text, "\n"),
        lambda line, i: F.struct(
            i.alias("at"), line.alias("line"), F.size(words_of(line)).alias("n")
        ),
    )
    most = PASSAGE_WORDS + 1

    def taken(near: Column) -> Column:
        """How many of some lines are a passage; null if all of them are not."""
        start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"))
        step = lambda a, x: F.when(a["n"] >= most, a).otherwise(
            F.struct((a["k"] + 1).alias("k"), (a["n"] + x["n"]).alias("n"))
        )
        return F.aggregate(near, start, step, lambda a: F.when(a["n"] >= most, a["k"]))

    def ends(real: Column) -> Column:
        after = lambda i: F.slice(real, i + 1, most)
        upto = lambda i: F.slice(
            real, F.greatest(i + 2 - most, F.lit(1)), F.least(i + 1, F.lit(most))
        )
        ahead = F.transform(
            real, lambda _, i: F.struct((i + 1).alias("i"), taken(after(i)).alias("k"))
        )
        behind = F.transform(
            real, lambda _, i: F.struct((i + 2).alias("i"), taken(F.reverse(upto(i))).alias("k"))
        )
        # Bound by a lambda, so that it is worked out once for a text and not once for a line.
        return F.element_at(F.transform(F.array(ahead), lambda a: both(real, a, behind)), 1)

    def both(real: Column, ahead: Column, behind: Column) -> Column:
        whole = lambda p: p["k"].isNotNull()
        begun = F.transform(F.filter(ahead, whole), lambda p: F.slice(real, p["i"], p["k"]))
        # Most passages that end at a line are those that begin at their first line, too.
        other = lambda p: ~F.get(ahead, p["i"] - p["k"] - 1)["k"].eqNullSafe(p["k"])
        ended = F.transform(
            F.filter(behind, lambda p: whole(p) & other(p)),
            lambda p: F.slice(real, p["i"] - p["k"], p["k"]),
        )
        return F.transform(
            F.concat(begun, ended),
            lambda p: F.struct(
                F.element_at(p, 1)["at"].alias("first"),
                F.element_at(p, -1)["at"].alias("last"),
                F.unhex(F.md5(F.array_join(p["line"], "\n"))).alias("sum"),
            ),
        )

    real = F.filter(lines, lambda x: x["n"] > 0)
    return F.element_at(F.transform(F.array(real), ends), 1)


def without_passages(docs: DataFrame) -> DataFrame:
    """The documents without runs of whole lines of over PASSAGE_WORDS words that came before.

    Rows are never dropped. A column n_chars follows the new text.
    """
    named = packed(
        docs, [c for c in docs.columns if c not in ("text", "n_chars")] or None, **named_text()
    )

    def without(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    shorter = F.element_at(F.transform(F.array(F.split("text", "\n")), without), 1)
    done = named.join(passage_lines(docs), ["doc", "copy"], "left")
    done = once(done, "short", F.when(F.col("gone").isNull(), F.col("text")).otherwise(shorter))
    new = {"text": F.col("short")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.coalesce(F.length("short"), F.lit(0)).cast(kind)
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def named_text() -> dict[str, Column]:
    """What tells a row's text from others: the document, and a hash of the text in it."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return {"doc": doc, "copy": F.xxhash64("text"), "text": F.col("text")}


def passage_lines(docs: DataFrame) -> DataFrame:
    """Per doc and copy (a hash of the text) the places of lines, counted from 0, of repeated
    passages; stored. Texts without such lines are left out.

    The first occurrence stays: that in the smallest doc_id (a null one is the largest), the first
    of that text; in one text only what does not overlap it goes. Equal
    rows with one doc_id keep the same. Only sums of passages are shuffled, no texts.
    """
    named = docs.select(*[value.alias(name) for name, value in named_text().items()])
    found = named.where("text is not null").select(
        "doc", "copy", F.explode(passages(F.col("text"))).alias("p")
    )
    found = materialize(found.select("doc", "copy", "p.first", "p.last", "p.sum"), "passages")
    place = F.struct("doc", "copy", "first", "last")
    repeated = (
        found.groupBy("sum")
        # Equal rows of one document are one place; they remove nothing below.
        .agg(F.min(place).alias("one"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sum", "one")
    )
    repeated = materialize(repeated, "repeated-passages")
    same_text = (F.col("doc") == F.col("one.doc")) & (F.col("copy") == F.col("one.copy"))
    gone = (
        found.join(repeated, "sum")
        .where(~same_text | (F.col("first") > F.col("one.last")))
        .select("doc", "copy", "first", "last")
        .distinct()
        .groupBy("doc", "copy")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
        .select("doc", "copy", F.array_distinct(F.flatten(
            F.transform("runs", lambda r: F.sequence(r["first"], r["last"]))
        )).alias("gone"))
    )
    return materialize(gone, "passage-lines")
