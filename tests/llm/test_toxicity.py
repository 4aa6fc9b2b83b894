"""Restored words, the language model next to a plain count, and accuracy on held-out labels."""

import random
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from reviewlab.llm import queries, toxicity

PLAIN = "you are a the of and stupid idiot moron worthless clown people walk home with that dog when all is said".split()


@pytest.fixture(scope="module")
def costs(spark):
    text = " ".join(PLAIN * 20)
    return toxicity.language_model(spark.createDataFrame([(text,), (None,)], "text string"))


@pytest.mark.parametrize(
    "form, word",
    [
        ("stupid", "stupid"), ("STUPID!!", "stupid"), ("st*pid", "stupid"), ("5tup1d", "stupid"),
        ("1d10t", "idiot"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("m-o-r-o-n", "moron"),
        ("m0r0n,", "moron"), ("w0rthle$$", "worthless"), ("(cl0wn)", "clown"), ("dog###", "dog"),
        ("2024", "2024"), ("3.14", "3.14"), ("", ""), ("all", "all"), ("***", ""), ("été", "été"),
    ],
)
def test_restored_words(costs, form, word):
    assert toxicity.Restorer(costs).words(pa.array([form])) == [word]


def test_letters_set_apart(costs):
    texts = pa.array(["you s t u p i d dog", "a b", "x x x x", None, "I D I O T", "1 2 3 4"])
    found = toxicity.restored_words(texts, toxicity.Restorer(costs))
    words = [found.words[c] for c in found.codes]
    lists = [[w for w, t in zip(words, found.text) if t == i] for i in range(len(texts))]
    assert lists[0] == ["you", "stupid", "dog"]
    assert lists[1:4] == [["a", "b"], ["x"] * 4, []]
    assert lists[4] == ["idiot"]


def test_viterbi_finds_the_best_path(costs):
    """Next to all paths through the lattice."""

    def price(word):
        classes = [0, 0, 0, *map(toxicity.letter_class, word), 0]
        return sum(costs[tuple(classes[i : i + 4])] for i in range(len(word) + 1))

    def paths(lattice, place=0):
        if place == len(lattice):
            return [(0.0, "")]
        return [
            (cost + rest, letters + more)
            for end, letters, cost in lattice[place]
            for rest, more in paths(lattice, end)
        ]

    rng = random.Random(4)
    for _ in range(60):
        form = "".join(rng.choices("stupidmorn015$.-@", k=rng.randrange(1, 8)))
        every = [(c + price(w), w) for c, w in paths(toxicity.arcs(form)) if w]
        found = toxicity.restore(form, costs.tolist())
        if every:
            least = min(every)[0]
            assert any(w == found and abs(c - least) < 1e-9 for c, w in every)
        else:
            assert found == form


def test_language_model_counts_all_words(spark):
    docs = ["The dog, the DOG", "é1 déjà dog", "", None, "dog " * 1000]
    words = [w.strip(toxicity.EDGES).lower() for d in docs for w in (d or "").split()]
    counts = Counter()
    for word in (w for w in words if w.isalpha()):
        classes = [0, 0, 0, *map(toxicity.letter_class, word), 0]
        counts.update(tuple(classes[i : i + 4]) for i in range(len(word) + 1))
    table = np.zeros((toxicity.CLASSES,) * 4)
    for key, n in counts.items():
        table[key] = n
    frame = spark.createDataFrame([(d,) for d in docs], "text string").repartition(3)
    found = toxicity.language_model(frame)
    assert np.allclose(found, toxicity.model_costs(table.ravel()))
    # Probabilities of all followers add up to one, and seen ones are likelier than unseen.
    assert np.allclose(np.exp(-found).sum(axis=-1), 1)
    d, o, g = map(toxicity.letter_class, "dog")
    assert found[d, o, g, 0] < log(2) < found[d, o, g, g]


def test_disguised_words_count(spark):
    """Learned from plain spelling, found in disguise; clean texts are left alone."""
    rng = random.Random(1)
    clean = [w for w in PLAIN if w not in ("stupid", "idiot", "moron", "worthless", "clown")]
    rude = ["stupid", "idiot", "moron", "worthless", "clown"]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(clean, k=20)
        toxic = i % 4 == 0
        if toxic:
            words[3:3] = rng.choices(rude, k=3)
        rows.append((i, " ".join(words), "x"))
        if i < 360:
            labels.append((i, int(toxic)))
    disguised = ["1d10t and m0r0n", "you are s t u p i d, an idiooot", "w0rthle$$ clooown", "st*pid i-d-i-o-t"]
    rows += [(1000 + i, text, "x") for i, text in enumerate(disguised)]
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, "the dog 100 times", "x"), (2002, "the dog", "x"), (None, "the dog", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    frame = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    found = [tuple(r) for r in toxicity.score_texts(docs, frame).collect()]
    assert len(found) == len(rows)
    scores = dict(found)
    assert [i for i in range(360, 400) if (scores[i] >= 0.5) != (i % 4 == 0)] == [], scores
    assert all(scores[1000 + i] >= 0.5 for i in range(len(disguised)))
    assert all(scores[i] < 0.5 for i in (2000, 2001, 2002, None))


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_texts(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_texts(docs, one).collect()} == {0.75}
    assert toxicity.score_texts(docs.limit(0), none).count() == 0


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op13_channel_toxicity(spark, folder)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    kept = rows.join(queries.table(spark, folder, "labels"), "doc_id").collect()
    assert rows.count() == queries.table(spark, folder, "documents").count()
    held = [r for r in kept if r["held_out"]]
    right = sum(r["predicted"] == r["toxic"] for r in held)
    assert len(held) > 50 and right >= 0.93 * len(held)


def test_restored_texts(spark):
    docs = spark.createDataFrame([(i, " ".join(PLAIN)) for i in range(50)] + [(50, "5tup1d  (dog)"), (51, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in toxicity.restore_texts(docs).where("doc_id >= 50").collect()}
    assert found == {50: "stupid dog", 51: ""}


def test_long_forms_are_restored_like_short_ones(costs):
    """A run of more than 40 single characters, and a form of as many without blanks."""
    letters = "stupid" * 20
    texts = pa.array([f"you {' '.join(letters)} dog", "5tup1d" * 10, "s.t.u.p.i.d." * 8])
    found = toxicity.restored_words(texts, toxicity.Restorer(costs))
    words = [[found.words[c] for c, t in zip(found.codes, found.text) if t == i] for i in range(3)]
    assert words[0] == ["you", toxicity.restore(letters, costs.tolist()), "dog"]
    assert words[1] == [toxicity.restore("5tup1d" * 10, costs.tolist())]
    assert words[1][0].isalpha() and words[2][0].isalpha()
    assert toxicity.restore("a1" * 5_000, costs.tolist()).isalpha()
