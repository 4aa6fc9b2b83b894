"""HTML extraction by wrapper induction.

The pages of a host that share a layout are aligned with one of them by simple tree matching. What
is the same in nearly all of them is the host's template and is left out, also inside articles; the slot that
holds most of the varying text is where the article is. An article that a page marks itself names
the slot, unless the host's pages show that its text does not vary. Menus, adverts, forms and
comments are left out by their names, as their text varies like that of articles.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import packed
from reviewlab.llm.html import BLOCK, Element, blocks, is_skipped, parse, squeezed
from reviewlab.llm.urls import url_parts
from reviewlab.session import materialize

#: Pages that must be aligned with a node, and the share that must be equal, for a constant one.
MIN_PAGES = 3
MIN_EQUAL = 0.9
#: Share of the varying text that the article's slot holds.
SLOT_SHARE = 0.6
#: Levels of a tree that are aligned; what is nested deeper counts to the last of them.
MAX_DEPTH = 60
#: Levels of containers that make a page's layout, and what holds the parts of a page.
LAYOUT_DEPTH = 4
CONTAINERS = set("#page html body center div main section table tbody td tr".split())
#: Nodes of a page that is aligned with all others, if there is one with so few.
FEW_NODES = 2_000
DIGITS = re.compile("[0-9]+")


@dataclass
class Skeleton:
    """A tree without text, in page order: labels, subtree sizes, hashes and lengths of own texts.

    Neighbouring elements with one name and marks are one node, so lists have one length; hash and
    length are kept for each of its elements. ``sources`` has the elements of each node.
    """

    labels: list[str]
    sizes: list[int]
    texts: list[list[int]]
    chars: list[list[int]]
    sources: list[list[Element]]

    def children(self, node: int) -> list[int]:
        out, child, end = [], node + 1, node + self.sizes[node]
        while child < end:
            out.append(child)
            child += self.sizes[child]
        return out


def own_text(element: Element) -> str:
    return squeezed(" ".join(p for p in element.parts if isinstance(p, str)))


def skeleton(root: Element) -> Skeleton:
    """The skeleton of a page, without what is skipped by its name."""
    import xxhash

    made = Skeleton([], [], [], [], [])

    def add(label: str, group: list[Element], depth: int) -> None:
        node = len(made.labels)
        own = [own_text(e) for e in group]
        made.labels.append(label)
        made.sizes.append(1)
        made.texts.append([xxhash.xxh64_intdigest(text) - 2**63 for text in own])
        made.chars.append([len(text) for text in own])
        made.sources.append(group)
        runs: list[tuple[str, list[Element]]] = []
        for element in group:
            for child in element.elements():
                if is_skipped(child, True):
                    continue
                name = f"{child.name}.{child.marks}"
                if runs and runs[-1][0] == name:
                    runs[-1][1].append(child)
                else:
                    runs.append((name, [child]))
        if depth < MAX_DEPTH:
            for name, run in runs:
                add(name, run, depth + 1)
        made.sizes[node] = len(made.labels) - node

    add("#page", [root], 0)
    return made


def layout(tree: Skeleton) -> int:
    """A hash of the containers in the upper levels, whatever their numbers and repeats."""
    import xxhash

    found, walk = set(), [(0, "", 0)]
    while walk:
        node, path, depth = walk.pop()
        path = f"{path}/{DIGITS.sub('#', tree.labels[node])}"
        found.add(path)
        if depth < LAYOUT_DEPTH:
            walk.extend(
                (child, path, depth + 1)
                for child in tree.children(node)
                if tree.labels[child].split(".", 1)[0] in CONTAINERS
            )
    return xxhash.xxh64_intdigest("\n".join(sorted(found))) - 2**63


def align(one: Skeleton, other: Skeleton) -> list[tuple[int, int]]:
    """Pairs of nodes by simple tree matching: as many as possible, in order, below pairs."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(a: int, b: int) -> int:
        if one.labels[a] != other.labels[b]:
            return 0
        if (a, b) in memo:
            return memo[a, b][0]
        left, right = one.children(a), other.children(b)
        table = [[0] * (len(right) + 1)]
        for i, x in enumerate(left):
            above, row = table[-1], [0]
            for j, y in enumerate(right):
                row.append(max(above[j + 1], row[j], above[j] + match(x, y)))
            table.append(row)
        memo[a, b] = (table[-1][-1] + 1, table)
        return memo[a, b][0]

    if not match(0, 0):
        return []
    pairs, walk = [], [(0, 0)]
    while walk:
        a, b = walk.pop()
        pairs.append((a, b))
        left, right, table = one.children(a), other.children(b), memo[a, b][1]
        i, j = len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                walk.append((left[i], right[j]))
    return pairs


TREE = "labels array<string>, sizes array<int>, texts array<array<long>>, chars array<array<int>>"


def trees(pages: DataFrame) -> DataFrame:
    """Per page rid, host, layout and its skeleton; stored. Pages without elements are left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [skeleton(parse(h or "")) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    pa.array([layout(s) for s in found], pa.int64()),
                    pa.array([s.labels for s in found], pa.list_(pa.string())),
                    pa.array([s.sizes for s in found], pa.list_(pa.int32())),
                    pa.array([s.texts for s in found], pa.list_(pa.list_(pa.int64()))),
                    pa.array([s.chars for s in found], pa.list_(pa.list_(pa.int32()))),
                ],
                names=["host", "layout", "labels", "sizes", "texts", "chars"],
            )

    made = pages.select("host", "html").mapInArrow(read, f"host string, layout long, {TREE}")
    made = made.where("size(labels) > 1")
    return materialize(made.select(F.monotonically_increasing_id().alias("rid"), "*"), "trees")


def layout_groups(stored: DataFrame) -> DataFrame:
    """Per host and layout: the group whose template its pages take, and whether they make it.

    A layout with MIN_PAGES pages is a group of its own. Rarer ones take the template of their
    host's most frequent layout, or are one group if the host has only rare ones.
    """
    sizes = stored.groupBy("host", "layout").agg(F.count("*").alias("n"))
    hosts = sizes.groupBy("host").agg(
        F.max_by("layout", F.struct("n", "layout")).alias("main"),
        F.max("n").alias("most"),
        F.sum("n").alias("pages"),
    )
    own = F.col("n") >= MIN_PAGES
    some = F.col("most") >= MIN_PAGES
    groups = sizes.join(hosts.where(f"pages >= {MIN_PAGES}"), "host").select(
        F.col("host").alias("of"),
        F.col("layout").alias("like"),
        F.when(own, F.col("layout")).when(some, F.col("main")).otherwise(0).alias("group"),
        (own | ~some).alias("makes"),
    )
    return materialize(groups, "layout-groups")


def reference_trees(members: DataFrame) -> DataFrame:
    """One page of every group, with as many different nodes as any: of, group, its skeleton."""
    kinds = F.struct(
        F.size("labels") <= FEW_NODES, F.size(F.array_distinct("labels")), -F.col("rid")
    )
    chosen = members.groupBy("of", "group").agg(F.max_by("rid", kinds).alias("rid")).select("rid")
    return members.join(chosen, "rid", "left_semi").select(
        "of", "group", *[F.col(c).alias(f"ref_{c}") for c in SHAPE]
    )


SHAPE = ("labels", "sizes", "texts", "chars")
COUNTS = ("aligned", "same", "varied")


def from_row(row: dict, prefix: str = "") -> Skeleton:
    return Skeleton(*[row[prefix + c] for c in SHAPE], [])


def distinct_pages(stored: DataFrame) -> DataFrame:
    """One of each host's equal pages: what copies share tells nothing about the template."""
    same = stored.select("rid", "host", F.xxhash64("labels", "sizes", "texts").alias("sum"))
    first = same.groupBy("host", "sum").agg(F.min("rid").alias("rid"))
    return stored.join(first.select("rid"), "rid", "left_semi")


def templates(stored: DataFrame) -> DataFrame:
    """Per host and layout (of, like, group, a reference tree, nodes): how the pages of the
    layout's group agree with the reference.

    ``nodes`` has for each node, with a null text: place, pages aligned, characters of elements
    with a text that the reference lacks there; and for each of the node's texts in the reference:
    pages that have it there too. Trees are small; counts are added up per batch before the
    shuffle, and pages of a group in many rows are joined by splitting them.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int, int, int | None], Counter] = {}
            for row in batch.to_pylist():
                page, reference = from_row(row), from_row(row, "ref_")
                for a, b in align(page, reference):
                    known = {t for t, n in zip(reference.texts[b], reference.chars[b]) if n}
                    other = sum(n for t, n in zip(page.texts[a], page.chars[a]) if t not in known)
                    count = counts.setdefault((row["of"], row["group"], b, None), Counter())
                    count.update(aligned=1, varied=other)
                    for text in known.intersection(page.texts[a]):
                        place = row["of"], row["group"], b, text
                        counts.setdefault(place, Counter()).update(same=1)
            rows = [
                {**dict(zip(("of", "group", "node", "text"), place)), **{c: count[c] for c in COUNTS}}
                for place, count in counts.items()
            ]
            yield pa.RecordBatch.from_pylist(
                rows,
                pa.schema(
                    [("of", pa.string())]
                    + [(c, pa.int64()) for c in ("group", "node", "text", *COUNTS)]
                ),
            )

    stored = distinct_pages(stored)
    groups = layout_groups(stored)
    members = stored.join(
        groups.where("makes"), (F.col("host") == F.col("of")) & (F.col("layout") == F.col("like"))
    ).select("rid", "of", "group", *SHAPE)
    references = materialize(reference_trees(members), "reference-trees")
    counts = (
        members.join(references, ["of", "group"])
        .drop("rid")
        .mapInArrow(
            compare,
            "of string, group long, node long, text long, aligned long, same long, varied long",
        )
        .groupBy("of", "group", "node", "text")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
        .groupBy("of", "group")
        .agg(F.collect_list(F.struct("node", "text", *COUNTS)).alias("nodes"))
    )
    found = materialize(references.join(counts, ["of", "group"]), "templates")
    return groups.drop("makes").join(found, ["of", "group"])


@dataclass
class Template:
    """The reference tree of a layout, the constant texts of its nodes, the nodes below which no
    text varies, and the slot of its articles."""

    tree: Skeleton
    constant: dict[int, set[int]]
    still: set[int]
    slot: int | None


def template_from(row: dict) -> Template:
    tree = from_row(row, "ref_")
    nodes = {n["node"]: n for n in row["nodes"] if n["text"] is None}
    constant: dict[int, set[int]] = {}
    for n in row["nodes"]:
        aligned = nodes[n["node"]]["aligned"]
        if n["text"] is not None and aligned >= MIN_PAGES and n["same"] >= MIN_EQUAL * aligned:
            constant.setdefault(n["node"], set()).add(n["text"])
    varied = [nodes[i]["varied"] if i in nodes else 0 for i in range(len(tree.labels))]
    below = [sum(varied[i : i + tree.sizes[i]]) for i in range(len(varied))]
    still = {i for i in nodes if nodes[i]["aligned"] >= MIN_PAGES and not below[i]}
    slot = None
    if below[0]:
        slot = 0
        while True:
            inner = [c for c in tree.children(slot) if below[c] >= SLOT_SHARE * below[0]]
            if not inner or inner[0] in constant:
                break
            # Paragraphs are not the slot, what holds them is.
            if tree.sizes[inner[0]] == 1 or tree.labels[inner[0]].startswith("p."):
                break
            slot = inner[0]
    return Template(tree, constant, still, slot)


def marked_articles(root: Element) -> list[Element]:
    """The outermost elements that say they are the article, or else the main part."""
    for wanted in ("article", "main"):
        found, walk = [], [root]
        while walk:
            element = walk.pop()
            if element.name == "article" and is_skipped(element, True):
                continue
            if element.name == wanted or (wanted == "main" and element.marks == "main"):
                found.append(element)
            elif not is_skipped(element, True):
                walk.extend(reversed(element.elements()))
        if found:
            return found
    return []


def constant_blocks(root: Element, same: set[int]) -> set[int]:
    """Ids of the elements of those blocks whose whole text is constant.

    ``same`` has the ids of elements whose own text is. A word that every page has in bold is no
    reason to take it out of its sentence, so a block goes as a whole or not at all.
    """
    owned: dict[int, list[Element]] = {}
    walk = [(root, id(root))]
    while walk:
        element, block = walk.pop()
        if own_text(element):
            owned.setdefault(block, []).append(element)
        for child in element.elements():
            if not is_skipped(child, True):
                walk.append((child, id(child) if child.name in BLOCK else block))
    whole = [found for found in owned.values() if all(id(e) in same for e in found)]
    return {id(e) for found in whole for e in found}


def article_text(html: str, template: Template | None) -> str:
    """The blocks of a page's article, joined by empty lines."""
    root = parse(html)
    found = marked_articles(root)
    if template is None:
        chosen, skip = found, set()
    else:
        page = skeleton(root)
        pairs = sorted(align(page, template.tree))
        same, still = set(), set()
        for a, b in pairs:
            fixed = template.constant.get(b, ())
            same.update(id(e) for e, t in zip(page.sources[a], page.texts[a]) if t in fixed)
            if b in template.still:
                still.update(id(e) for e in page.sources[a])
        skip = constant_blocks(root, same)
        chosen = [e for e in found if id(e) not in still]
        chosen = chosen or [e for a, b in pairs if b == template.slot for e in page.sources[a]]
    return "\n\n".join(
        text for e in chosen or [root] for text in blocks(e, skip, bool(chosen))
    )


def with_layout(rows: DataFrame) -> DataFrame:
    """Add the layout of each row's page."""
    names = [*rows.columns, "layout"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [layout(skeleton(parse(h or ""))) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], names=names
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(read, f"{kinds}, layout long")


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points).

    Null or empty html gives an empty text; a null url belongs to the empty host. Repeated rows
    are extracted each. Hosts with fewer than MIN_PAGES different pages have no template. Pages are
    shuffled once at most, to their layout's template, which is small; a layout with very many
    pages is split.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple[str, int], Template] = {}
        for batch in batches:
            hosts = list(zip(batch.column("of").to_pylist(), batch.column("group").to_pylist()))
            texts = []
            for row, (html, host) in enumerate(zip(batch.column("html").to_pylist(), hosts)):
                if host[0] is not None and host not in made:
                    if len(made) >= 1000:
                        made.clear()
                    columns = [*(f"ref_{c}" for c in SHAPE), "nodes"]
                    made[host] = template_from({c: batch.column(c)[row].as_py() for c in columns})
                texts.append(article_text(html or "", made.get(host)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["row", "text", "n_chars"],
            )

    host = url_parts(F.col("url"))["host"]
    rows = packed(pages, ["page_id", "url"], host=host, html=F.col("html"))
    found = templates(trees(rows))
    joined = (
        with_layout(rows)
        .join(found, (F.col("host") == F.col("of")) & (F.col("layout") == F.col("like")), "left")
        .drop("host", "layout", "like")
    )
    row_type = rows.schema["row"].dataType.simpleString()
    done = joined.mapInArrow(read, f"row {row_type}, text string, n_chars long")
    return done.select("row.page_id", "row.url", "text", "n_chars")
