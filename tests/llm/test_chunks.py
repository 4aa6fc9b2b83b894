import bisect
import hashlib
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlab.llm import chunks
from reviewlab.llm.common import is_among, lower_bound


def cut(text):
    if text is None:
        return []
    out, here, above, last = [], [], 0, 1
    lines = text.split("\n")
    for line, below in zip(lines, [*lines[1:], ""]):
        value = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
        here.append(line)
        rolled = (value + chunks.WEIGHT * above) % chunks.DIVISOR
        long = chunks.LONG_LINE <= max(len(line), len(below))
        if (rolled == 0 and last != 0) or long:
            out.append(here)
            here = []
        above, last = value, rolled
    return out + [here] if here else out


def expected(texts):
    seen, out = set(), []
    for text in texts:
        left = []
        for lines in cut(text):
            body = "\n".join(lines)
            if (len(lines) > 1 or len(body) >= chunks.LONG_LINE) and body.strip(" \t\n\x0b\x0c\r"):
                if body in seen:
                    continue
                seen.add(body)
            left.append(body)
        out.append("\n".join(left))
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", " ", "a", "b", "c d", "é", "é long" * 60, " " * 400]), max_size=30), max_size=12))
def test_like_brute_force(spark, texts):
    texts = ["\n".join(lines) for lines in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = chunks.without_repeated(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in done] == expected(texts)


def test_a_moved_passage_is_found(spark):
    passage = [f"line {i} of a passage" for i in range(40)]
    texts = ["\n".join(["one"] + passage), "\n".join(["x", "y", "z"] + passage + ["end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = chunks.drop_repeated(docs).orderBy("row.doc_id").collect()
    assert done[0]["n_removed_lines"] == 0
    assert done[1]["n_removed_lines"] >= 30


def test_odd_rows(odd_docs, no_docs):
    done = chunks.without_repeated(odd_docs)
    assert done.columns == odd_docs.columns and done.count() == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in done.collect()}
    assert texts[3] is None and texts[4] == "" and len(texts[7]) == 50_000
    assert chunks.without_repeated(no_docs).count() == 0


def without_runs(texts):
    return [
        "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        for text, gone in zip(texts, runs_of(texts))
    ]


def runs_of(texts):
    """Brute force: places of lines of any run of over 50 words that an earlier text has."""
    wordy = [[(i, line) for i, line in enumerate(t.split("\n")) if line.split()] for t in texts]
    out = []
    for number, text in enumerate(texts):
        own, gone = wordy[number], set()
        for a in range(len(own)):
            for b in range(a, len(own)):
                run = [line for _, line in own[a : b + 1]]
                if sum(len(line.split()) for line in run) <= 50:
                    continue
                at = lambda w, n: [i for i in range(n) if [x for _, x in w[i : i + len(run)]] == run]
                if any(at(w, len(w)) for w in wordy[:number]) or any(i + len(run) <= a for i in at(own, a)):
                    gone.update(range(own[a][0], own[b][0] + 1))
        out.append(gone)
    return out


def test_passages_between_unlike_neighbours(spark):
    passage = [f"line {i} has a few words of its own in it" for i in range(6)]
    long = " ".join(f"w{i}" for i in range(51))
    texts = [
        "\n".join(["one", *passage, "two", long, "three"]),
        "\n".join(["four", *passage[:3], "", *passage[3:], "five", passage[0], "six"]),
        "\n".join(["seven", long, *passage[1:], "eight"]),
        "\n".join(["a b"] * 90),
        "\n".join(["x", *["y z " + str(i) for i in range(20)], "u", *["y z " + str(i) for i in range(20)]]),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = [r["text"] for r in chunks.without_passages(docs).orderBy("doc_id").collect()]
    assert done[:3] == [texts[0], "four\nfive\n" + passage[0] + "\nsix", "seven\neight"]
    assert done == without_runs(texts)


def test_passages_of_odd_rows(odd_docs, no_docs):
    done = chunks.without_passages(odd_docs)
    assert done.columns == odd_docs.columns and done.count() == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in done.collect()}
    assert texts[3] is None and texts[4] == "" and len(texts[7]) == 50_000
    assert chunks.without_repeated(done).count() == odd_docs.count()
    assert chunks.without_passages(no_docs).count() == 0


def test_documents_without_words_go(odd_docs):
    rows = {(r["doc_id"], r["text"]) for r in chunks.with_words(odd_docs).collect()}
    kept = {(r["doc_id"], r["text"]) for r in odd_docs.collect() if (r["text"] or "").split()}
    assert rows == kept and chunks.with_words(odd_docs).columns == odd_docs.columns


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b c", "w " * 30, "x " * 26, "y " * 51, "", "z"]), max_size=9), min_size=1, max_size=5))
def test_passages_of_any_texts(spark, texts):
    """Passages that begin and end at the same lines are looked at once; nothing is missed."""
    docs = ["\n".join(lines) for lines in texts]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    done = [r["text"] for r in chunks.without_passages(frame).orderBy("doc_id").collect()]
    assert done == without_runs(docs)


def test_many_chunks_found_twice(spark):
    """Look-ups grow with the logarithm of a text's chunks; the rows are those of brute force."""
    text = "\n".join(f"line {i % 977} of {i // 3} x" for i in range(40_000))
    docs = spark.createDataFrame([(0, text), (1, text)], "doc_id long, text string")
    started = time.monotonic()
    done = [r["text"] for r in chunks.without_repeated(docs).orderBy("doc_id").collect()]
    assert done == expected([text, text]) and time.monotonic() - started < 30


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=40), st.integers(-1, 61))
def test_binary_search(spark, values, x):
    row = spark.createDataFrame([(sorted(values), x)], "v array<int>, x int")
    found = row.select(lower_bound(F.col("v"), F.col("x")), is_among(F.col("v"), F.col("x"))).first()
    assert tuple(found) == (bisect.bisect_left(sorted(values), x), x in values)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b c", "w " * 30, "x " * 26, "y " * 51, "", "z", "é long " * 60]), max_size=9), min_size=1, max_size=5))
def test_passages_and_chunks_together(spark, texts):
    """What either rule takes out goes, nothing else does, and no line is lost everywhere."""
    docs = ["\n".join(lines) for lines in texts]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    gone = chunks.passage_lines(frame)
    done = [r["text"] for r in chunks.without_repeated(frame, gone).orderBy("doc_id").collect()]
    assert [t.split() for t in without_both(docs)] == [t.split() for t in done]
    assert {x for t in done for x in t.split("\n")} | {""} == {x for t in docs for x in t.split("\n")} | {""}


def without_both(texts):
    """Brute force: places of lines that the chunk rule or the passage rule takes out."""
    seen, out = set(), []
    for text, runs in zip(texts, runs_of(texts)):
        at, left = 0, []
        for lines in cut(text):
            body = "\n".join(lines)
            counts = (len(lines) > 1 or len(body) >= chunks.LONG_LINE) and body.split()
            if not (counts and body in seen):
                left += [x for i, x in enumerate(lines, at) if i not in runs]
            if counts:
                seen.add(body)
            at += len(lines)
        out.append("\n".join(left))
    return out
