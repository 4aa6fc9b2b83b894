import os
import random
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from reviewlab.llm import decontaminate

ITEMS = [
    (1, "What is the capital of the country of France? The answer is the city Paris."),
    (2, "one long single sentence item about seven purple elephants dancing"),
    (3, None),
    (4, "  "),
    (2, "a second item has the same number. But another answer altogether here"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_leaks_are_found(spark, items):
    filler = [f"word{i % 97}" for i in range(5000)]
    texts = {
        1: " ".join(filler[:700]) + "\n" + ITEMS[0][1].upper() + " " + " ".join(filler),
        2: ITEMS[1][1].replace(" ", "\n\t"),
        3: "What is the capital of the country of France?",
        4: "seven purple elephants dancing",
        5: " ".join(filler),
        6: None,
        7: "",
        8: ITEMS[4][1],
        9: "the of is the of city capital answer Paris France country What",
    }
    rows = [*texts.items(), (2, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.find_leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 1), (2, 2), (2, 2), (8, 2)]
    kept = decontaminate.without_leaks(docs, items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7, 9]


def test_no_passage_is_pruned_wrongly():
    draw = random.Random(3)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(3, 30))) for _ in range(150)]
    seen = {}
    for text in texts:
        for term in set(decontaminate.terms_of(text)):
            seen[term] = seen.get(term, 0) + 1
    index = decontaminate.Index(list(enumerate(texts)), seen, len(texts), 16.0)
    import numpy as np

    stream = []
    for text in draw.sample(texts, 20):
        stream += draw.choices(vocabulary, k=draw.randint(0, 50)) + text.split()
    words = np.array([index.ids.get(w, -1) for w in stream])
    found = {(item, first) for item, first, _, _ in index.search(words)}
    wanted = set()
    for block in index.blocks:
        for first in range(0, len(words), block.longest):
            window = set(words[first : first + 2 * block.longest].tolist())
            rows = np.unique(block.rows[sorted(window)])
            scores = block.impacts[rows].sum(axis=0)
            for hit in np.flatnonzero(scores >= block.needed * (1 - 1e-4)):
                wanted.add((int(block.items[hit]), first))
    assert found == wanted and found


def test_parts_of_the_index(spark, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 60)
    docs = spark.createDataFrame([(1, ITEMS[0][1]), (2, ITEMS[1][1])], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 1), (2, 2)]


def test_parts_remove_the_same_documents(spark, items, monkeypatch):
    rows = [(1, ITEMS[0][1]), (2, ITEMS[1][1]), (3, None), (4, "clean text"), (2, ITEMS[1][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, leak string")
    whole = sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 60)
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()) == whole
    assert whole == [3, 4]


def test_workers_need_no_package(tmp_path):
    """The search function and its index load where only the libraries are."""
    text = ITEMS[0][1]
    seen = {t: 1 for t in decontaminate.terms_of(text)}
    data = decontaminate.Index([(7, text)], seen, 1, 15.0).to_bytes()
    search = decontaminate.searcher(SimpleNamespace(value=data))
    (tmp_path / "search").write_bytes(cloudpickle.dumps(search))
    script = (
        "import pickle, sys, pyarrow as pa\n"
        "search = pickle.load(open('search', 'rb'))\n"
        f"print([h['item'] for h in search(pa.array([{text!r}]))[0].as_py()])\n"
        "assert not any(name.startswith('reviewlab') for name in sys.modules)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "[7]"


def test_odd_rows(odd_docs, no_docs, items):
    assert decontaminate.without_leaks(odd_docs, items).count() == odd_docs.count()
    assert decontaminate.without_leaks(odd_docs, items).columns == odd_docs.columns
    assert decontaminate.find_leaks(no_docs, items).count() == 0
    assert decontaminate.find_leaks(odd_docs, items.limit(0)).count() == 0
