import random

import numpy as np
import pyarrow as pa
import pytest

from reviewlab.llm import neardup
from reviewlab.llm.components import components


def sets_of(text, shingle):
    words = (text or "").encode().lower().split()
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)}


def brute_force(texts, shingle, percent):
    sets = {i: sets_of(t, shingle) for i, t in texts.items()}
    component = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    low, high = sorted((component[a], component[b]))
                    component = {i: low if c == high else c for i, c in component.items()}
    return {i: (len(sets[i]), component[i], component[i] == i) for i in texts}


@pytest.mark.parametrize("shingle, percent", [(3, 85), (5, 80)])
def test_like_brute_force(spark, shingle, percent):
    draw = random.Random(7)
    texts = {}
    for family in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([2, 30, 120]))]
        for _ in range(draw.choice([1, 3, 25])):
            copy = list(words)
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                copy[draw.randrange(len(copy))] = f"v{draw.randrange(5000)}"
            texts[len(texts)] = " ".join(copy)
    texts[len(texts)] = "A b C"
    texts[len(texts)] = "a B c"
    texts[len(texts)] = " \n"
    order = list(texts)
    draw.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string")
    rows = neardup.near_duplicates(docs, shingle=shingle, percent=percent).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert found == brute_force(texts, shingle, percent)


def test_a_chain_of_copies_is_one_component(spark):
    words = [f"w{i}" for i in range(100)]
    rows = []
    for step in range(40):
        words[2 * step] = f"v{step}"
        rows.append((1000 - step, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, shingle=3, percent=85).collect()
    assert {r["component_id"] for r in found} == {961}


def test_estimate():
    draw = np.random.default_rng(2)
    for common, own in ((900, 50), (500, 500), (100, 900)):
        pool = draw.integers(0, 2**63, common + 2 * own, np.uint64)
        one, other = pool[: common + own], np.concatenate((pool[:common], pool[common + own :]))
        sketches = [neardup.registers(s)[None, :] for s in (one, other)]
        size = np.array([common + own], float)
        found = neardup.likely_similarity(*sketches, size, size)[0]
        assert abs(found - common / (common + 2 * own)) < 0.15
    both = neardup.merge(neardup.registers(one), neardup.registers(other))
    assert (both == neardup.registers(np.unique(pool))).all()


def test_shingles_do_not_cross_texts():
    sets = neardup.shingle_sets(pa.array(["a b c", "a b", "B\tA", None, "a b c", "a  B"]), 3)
    assert [len(s) for s in sets] == [1, 1, 1, 0, 1, 1]
    assert sets[0][0] == sets[4][0] and sets[1][0] == sets[5][0] and sets[1][0] != sets[2][0]


def test_components(spark):
    draw = random.Random(11)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(400, 400)]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2200)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in range(300):
        for a, b in links:
            if a != b:
                wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    assert {r["node"]: r["component"] for r in found} == wanted


def test_odd_rows(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    ids = {r["doc_id"]: r["component_id"] for r in rows}
    assert ids[3] == 3 and ids[4] == 4 and ids[None] is None
    kept = neardup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    assert neardup.near_duplicates(no_docs).count() == 0
