"""Token files, separator scan and byte-level BPE against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from reviewlab.llm import bpe, repair, separators, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "Hello  world, it's   a \n test\t of odd  spaces \r\n end ",
    " leading and trailing ",
    " 　wide \x85 blanks\x1c here \x0b\x0c",
    "é ́ combining İstanbul ẞ ﬁ 𝄞𝄞 123456 don't we'LL",
    "<|endoftext|> \" quote a\"b <|startoftext|>x",
    "",
    " ",
    "x" * 3000,
    "the " * 2000,
    "a​b﻿c 日本語 テキスト العربية",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    letters = list("abcdeé'\".,;<|> \t\n\x0b ́ßİ1") + ["the ", "ing ", "  "]
    return TEXTS + ["".join(draw.choices(letters, k=200)) for _ in range(200)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [*enumerate(texts), (None, "no id"), (5, None), (3, texts[3])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def whole_ids(texts, special_is_text=True):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = special_is_text
    return [e.ids for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def test_words_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    ids, lengths = tokens.encode_texts(pa.array(texts), WORDS, 1)
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [[*own, 1] for own in whole_ids(texts)]


def test_special_names_as_the_library_gives_them(texts):
    import pyarrow as pa

    more = ["a <|endoftext|> b", "<|endoftext|>", "x<|ENDOFTEXT|>", "<|startoftext|><|endoftext|>é", None]
    for some in (texts + more, more, texts[-5:], []):
        ids, lengths = tokens.with_special(pa.array(some, pa.string()), WORDS, 1)
        parts = np.split(ids, np.cumsum(lengths)[:-1]) if some else []
        wanted = whole_ids([t or "" for t in some], special_is_text=False)
        assert [p.tolist() for p in parts] == [[*own, 1] for own in wanted]


def test_token_files(spark, docs, texts):
    rows = repair.stored_tokens(docs, WORDS).collect()
    assert len(rows) == len(texts) + 3
    by_start = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted(
        [*range(len(texts)), -1, 5, 3]
    ) or by_start[0]["doc_id"] is None
    at = 0
    for row in by_start:
        assert row["start"] == at
        at += row["n_tokens"]
    own = whole_ids(texts, special_is_text=False)
    for row in rows:
        if row["doc_id"] not in (None, 5):
            ids = np.array([*own[row["doc_id"]], 1], "<u4")
            assert row["n_tokens"] == len(ids)
            assert row["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_grammar_is_smaller_and_opens_anywhere():
    draw = np.random.default_rng(3)
    lengths = draw.integers(1, 400, 300)
    parts = [np.append(np.tile(draw.integers(0, 9, 5), 80)[: n - 1], 1) for n in lengths]
    ids = np.concatenate(parts).astype(np.uint16)
    grammar = repair.from_bytes(repair.to_bytes(repair.compress(ids, lengths)))
    assert len(grammar.symbols) < len(ids) / 2
    assert (repair.expand(grammar, grammar.symbols) == ids).all()
    for n in (0, 7, 299):
        assert (repair.decode_document(grammar, n) == parts[n]).all()


def test_no_documents(spark, no_docs):
    assert repair.stored_tokens(no_docs, WORDS).count() == 0
    files = separators.flat_files(no_docs, WORDS, 49_407)
    assert separators.count_tokens(files, 49_407).count() == 0
    assert bpe.encode_and_decode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_separator_scan(spark, monkeypatch):
    monkeypatch.setattr(separators, "GROUP", 2)
    draw = np.random.default_rng(1)
    rows, wanted = [], []
    for file in range(3):
        ids = draw.integers(0, 30, 400)
        ids = np.append(ids, [0, 0] if file else [7, 7])
        start = number = 0
        for end in [*np.flatnonzero(ids == 0), None]:
            stop = len(ids) if end is None else end + 1
            if stop > start:
                wanted.append((file, number, start, stop - start, end is not None))
            start, number = stop, number + 1
        cuts = [0, 1, 50, 50, 300, len(ids)]
        for block, (a, b) in enumerate(zip(cuts, cuts[1:])):
            rows.append((file, block * 3, bytearray(ids[a:b].astype("<u2").tobytes())))
        rows.append((file, 100, None))
    files = spark.createDataFrame(rows, "file long, block long, tokens binary")
    found = separators.count_tokens(files, 0).collect()
    columns = ("file", "doc_no", "start", "n_tokens", "terminated")
    assert sorted(tuple(r[c] for c in columns) for r in found) == sorted(wanted)


def test_flat_files_hold_every_document(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(separators, "BLOCK_IDS", 512)
    files = separators.flat_files(docs, WORDS, 49_407)
    found = separators.count_tokens(files, 49_407).orderBy("file", "doc_no").collect()
    lengths = [len(ids) + 1 for ids in whole_ids([*texts, "no id", "", texts[3]])]
    assert sorted(r["n_tokens"] for r in found) == sorted(lengths)
    assert all(r["terminated"] for r in found)


def test_distinct_words(spark, docs, texts):
    rows = bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.load_ranks(RANKS),
        special_tokens={},
    )
    digest = lambda raw: hashlib.sha256(raw).hexdigest()
    found = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    wanted = []
    for doc_id, text in [*enumerate(texts), (0, "no id"), (5, ""), (3, texts[3])]:
        ids = library.encode_ordinary(text)
        wanted.append(
            (doc_id, len(ids), digest(" ".join(map(str, ids)).encode()), digest(text.encode()))
        )
    assert found == sorted(wanted)
