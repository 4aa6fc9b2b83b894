"""Syllables of known words, and reading ease next to a plain count."""

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.functions.syllables import Trie, parsed, patterns
from reviewlab.operators import readability, words
from reviewlab.session import materialize

KNOWN = """
the 1 a 1 be 1 she 1 table 2 tables 2 troubled 2 make 1 makes 1 walked 1 wanted 2 needed 2
boxes 2 dishes 2 churches 2 nation 2 delicious 3 serious 3 piano 3 video 3 people 2 gorgeous 2 quality 3 question 2
unique 2 quiet 2 diet 2 science 2 create 2 reality 4 read 1 great 1 idea 3 area 3 sea 1 beautiful 3
movie 2 movies 2 going 2 doing 2 playing 2 flying 2 beyond 2 yes 1 yellow 2 lovely 2 movement 2 element 3
careless 2 business 2 something 2 somewhere 2 league 1 argue 2 language 2 actual 3 ruin 2 fluid 2 cruel 2 fuel 2
prism 2 eye 1 employed 2 guess 1 guide 1 suite 1 happier 3 chaos 2 acre 2 rhythm 1 film 1 actor 2
director 3 character 3 interesting 4 performance 3 story 2 2024 1 hmm 1 called 1 little 2 bottle 2 please 1 house 1
because 2 watched 1 hated 2 enjoyable 4 comedy 3 terrible 3 horrible 3 excellent 3 amazing 3 boring 2 scene 1 audience 3
experience 4
"""


def test_known_words():
    words = KNOWN.split()
    trie = Trie(patterns())
    found = {word: trie.syllables(word) for word in words[::2]}
    assert found == dict(zip(words[::2], map(int, words[1::2])))


def test_highest_bid_wins():
    assert parsed("a1b2.") == ("ab.", (0, 1, 2, 0))
    trie = Trie(["1a", "a2b", "3b", "ab4c"])
    assert trie.bids("abc") == [0, 1, 3, 4, 0, 0]
    assert trie.syllables("abc") == 2 and trie.syllables("") == 1


def test_patterns_next_to_a_search_of_all_places():
    trie = Trie(patterns())
    for word in KNOWN.split()[::2] + ["", "e", "aeiouy" * 40, "x" * 300]:
        line, best = f".{word}.", {}
        for letters, bids in map(parsed, patterns()):
            for at in range(len(line)):
                if line.startswith(letters, at):
                    for k, bid in enumerate(bids):
                        best[at + k] = max(best.get(at + k, 0), bid)
        assert trie.bids(word) == [best.get(i, 0) for i in range(len(line) + 1)]


def test_reading_ease(spark):
    texts = ["The movie was terrible. Walked out!", "Film", None, "", "... !?", "Idea one. " * 5000, "Fine 99 film"]
    rows = [(str(i % 4), t, "x") for i, t in enumerate(texts)] + [(None, "Film", "x"), ("0", texts[0], "x")]
    frame = spark.createDataFrame(rows, "review_id string, review_detail string, word string").repartition(3)
    scored = readability.with_reading_ease(frame)
    assert scored.columns == ["review_id", "review_detail", "word", "reading_ease"]
    found = scored.collect()
    assert len(found) == len(rows)
    trie = Trie(patterns())
    import re

    for row in found:
        words = re.findall("[a-z0-9]+", (row["review_detail"] or "").lower())
        if not words:
            assert row["reading_ease"] is None
            continue
        ends = max(1, len(re.findall("[.!?]+", row["review_detail"])))
        syllables = sum(map(trie.syllables, words))
        want = text.FLESCH_BASE - text.FLESCH_PER_SENTENCE * len(words) / ends
        want -= text.FLESCH_PER_WORD * syllables / len(words)
        assert row["reading_ease"] == pytest.approx(want, rel=1e-6)
    assert readability.with_reading_ease(frame.limit(0)).count() == 0


def test_each_distinct_word_once(spark):
    frame = spark.createDataFrame([("a b a",), ("b c",), (None,)], "cleaned_review string")
    rows = {r["word"]: (r["df"], r["syllables"]) for r in readability.word_table(frame).collect()}
    assert rows == {"a": (1, 1), "b": (2, 1), "c": (1, 1)}


def test_reading_ease_stores_and_sorts_no_words(spark, monkeypatch):
    """Also where the word table is too large to be broadcast, and with rows that come twice."""
    rows = [(str(i % 40), f"Rare{i % 40} words, the cat sat. The table{i % 3}!") for i in range(60)]
    rows += [(None, "A cat."), (None, "A cat."), ("7", None), ("8", "...")]
    frame = spark.createDataFrame(rows, "review_id string, review_detail string")
    want = sorted(readability.with_reading_ease(frame).collect(), key=str)
    labels, plans = [], []

    def recorded(df, label):
        labels.append(label)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(words, "MAX_BROADCAST_WORDS", 3)
    monkeypatch.setattr(words, "materialize", recorded)
    monkeypatch.setattr(readability, "materialize", recorded)
    got = sorted(readability.with_reading_ease(frame).collect(), key=str)
    assert got == want and len(got) == 64
    assert sum(row["reading_ease"] is None for row in got) == 2
    assert "terms" not in labels
    assert "Exchange" not in plans[labels.index("spoken-words")]


def test_spoken_words(spark):
    texts = [" Don't stop -- 2 Cats! ", "...", "", None, "É9 a_b\nC"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in frame.select(readability.spoken_words(F.col("t"))).collect()]
    assert got == ["don t stop 2 cats", "", "", None, "9 a b c"]
