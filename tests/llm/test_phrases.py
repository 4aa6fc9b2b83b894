"""Collocations next to SQL over all phrases, and next to a count of all phrases."""

import random
import re
from collections import Counter

import pytest

from checks.compare import connect, rows_of
from reviewlab.llm import oracle, phrases, queries


def brute(docs):
    counts, sizes = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts[(lang, *words[i : i + n])] += 1
    found = {}
    for key, a in counts.items():
        lang, *words = key
        if len(words) == 1 or a < phrases.LEAST:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((phrases.UNIT * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found[key] = (a, left, right, score)
    most = Counter()
    for (lang, *words), (a, *_) in found.items():
        if len(words) == 3:
            for pair in (words[:2], words[1:]):
                most[(lang, *pair)] = max(most[(lang, *pair)], a)
    rows = {}
    for (lang, *words), (a, left, right, score) in found.items():
        longer = most[(lang, *words)] if len(words) == 2 else 0
        if not longer or 100 * longer < phrases.ABSORBED * a:
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = set()
    for lang, listed in rows.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[: phrases.KEEP], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


def found_in(spark, docs):
    frame = spark.createDataFrame(docs, "text string, lang string, flags int").repartition(3)
    result = phrases.collocations(frame)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(row) for row in result.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_agrees_with_sql(spark, small):
    result = queries.op11_phrase_growth(spark, small)
    mine = rows_of(result.columns, [tuple(row) for row in result.collect()])
    relation = connect(small).sql(oracle.ORACLE["op11_phrase_growth"])
    assert mine and mine == rows_of(relation.columns, relation.fetchall())


def corpus(seed):
    """Three languages of different sizes, with fixed expressions among random words."""
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(30)]
    fixed = ["New York City", "ad hoc", "é à ô", "as well as", "x\ty z"]
    docs = []
    for i in range(120):
        words = [
            rng.choice(fixed) if rng.random() < 0.3 else rng.choices(common, range(1, 31))[0]
            for _ in range(rng.randrange(60))
        ]
        ends = [rng.choice(["", "", "", ".", ",", "\n", "!? ", " ;"]) for _ in words]
        text = " ".join(w + e for w, e in zip(words, ends))
        docs.append((text, rng.choice(["en", "en", "de", None]), i))
    return docs


@pytest.mark.parametrize("keep, ranks", [(2000, (4000, 32000)), (20, (5, 25)), (7, (1, 2))])
def test_random_texts(spark, monkeypatch, keep, ranks):
    """With few wanted, the bar is set high and lowered; ties stand at the border."""
    monkeypatch.setattr(phrases, "KEEP", keep)
    monkeypatch.setattr(phrases, "BAR_RANKS", ranks)
    monkeypatch.setattr(phrases, "LEAST", 4)
    docs = corpus(keep)
    assert found_in(spark, docs) == brute([d[:2] for d in docs])


def test_flags_may_collide(spark, monkeypatch):
    """A flag table that is far too small counts more and finds the same."""
    monkeypatch.setattr(phrases, "FLAG_BITS", 3)
    monkeypatch.setattr(phrases, "KEEP", 15)
    monkeypatch.setattr(phrases, "BAR_RANKS", (10,))
    docs = corpus(3)
    assert found_in(spark, docs) == brute([d[:2] for d in docs])


def test_odd_texts(spark):
    assert found_in(spark, [(None, None, 1), ("", "en", 1), (" .\n,\t", "en", 2)]) == set()
    long = ("to be or not to be. " * 3000, "en", 1)
    repeated = [("A b c", None, 1)] * 12 + [("a b", "x y", 1)] * 10
    docs = [long, *repeated, (None, "en", 0), ("ÀB Àb", "fr", 2)]
    assert found_in(spark, docs) == brute([d[:2] for d in docs])


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**13
    frame = spark.createDataFrame([(big, big + 1, big - 1)], "a long, l long, r long")
    want = phrases.UNIT * big * big // ((big + 1) * (big - 1))
    assert frame.select(phrases.score("a", "l", "r")).first()[0] == want
