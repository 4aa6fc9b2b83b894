"""Token ids of whole texts, block by block, inside Arrow tasks.

Texts are split at white space by Arrow, and equal words of a block are merged. Words are cut into
the pieces that the tokenizer's own pattern would cut, and only pieces that the worker has not met
before go through the tokenizer. For a tokenizer that lowers case, drops white space and marks
word ends this gives the ids of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewlab.llm.common import worker_cache

#: Bytes of text that are worked on at once; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Pieces that a worker remembers, and how many are encoded at once.
CACHE_PIECES = 2_000_000
TOGETHER = 1000

# Punctuation of ASCII but the apostrophe, which takes part in contractions; the
# characters that are lowered alike everywhere (RE2); the pieces that the tokenizer's file cuts.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
UNSAFE = r"[^\x21-\x7E\x{A1}-\x{12F}\x{131}-\x{17F}]"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


class PieceIds:
    """Ids of pieces by a tokenizers file, as one array with places; known pieces are kept."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.cut = regex.compile(PIECES).findall
        # Pieces are normalized already. Names of special tokens in a text are ordinary text.
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        """Only the empty piece is known, which has no ids."""
        self.known = pa.array([""], pa.string())
        self.stops = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces, many in one text; every piece ends with the only word end it has."""
        texts = [" ".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint16) for e in encoded])
        stops = np.flatnonzero(self.is_end[ids]) + 1
        if len(stops) != len(pieces):
            raise ValueError("this tokenizer does not mark the ends of words")
        self.stops = np.concatenate((self.stops, stops + len(self.ids)))
        self.ids = np.concatenate((self.ids, ids))
        self.known = pa.concat_arrays([self.known, pa.array(pieces, pa.string())])

    def lookup(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in ``ids`` of each of some distinct pieces."""
        if len(self.known) + len(pieces) > CACHE_PIECES:
            self.forget()
        found = pc.index_in(pieces, self.known)
        rows = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = len(self.known) + np.arange(len(new))
            self.learn(pieces.take(pa.array(new)).to_pylist())
        starts = np.concatenate(([0], self.stops[:-1]))[rows]
        return starts, self.stops[rows] - starts

    def pieces_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(codes of the pieces of all words, pieces per word, the distinct pieces).

        Most words are letters with punctuation behind them; those are cut by Arrow into two
        pieces, of which one may be empty. Others go through the tokenizer's own normalizer and
        pattern.
        """
        low = pc.utf8_lower(words)
        head = pc.utf8_rtrim(low, PUNCTUATION)
        plain = pc.or_(pc.utf8_is_alpha(head), pc.equal(head, ""))
        plain = pc.and_not(plain, pc.match_substring_regex(words, UNSAFE))
        plain = plain.to_numpy(zero_copy_only=False)
        behind = (pc.binary_length(low).to_numpy() - pc.binary_length(head).to_numpy()) * plain
        with_tail = np.flatnonzero(behind)
        tails = [
            word[-int(n) :]
            for word, n in zip(low.take(pa.array(with_tail)).to_pylist(), behind[with_tail])
        ]
        odd = [
            self.cut(self.normalize(word))
            for word in words.filter(pa.array(~plain)).to_pylist()
        ]
        pieces = pa.concat_arrays(
            [
                pc.if_else(pa.array(plain), head, ""),
                pa.array([""] + tails, pa.string()),
                pa.array([piece for cut in odd for piece in cut], pa.string()),
            ]
        ).dictionary_encode()
        codes = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.full(len(words), 2)
        counts[~plain] = [len(cut) for cut in odd]
        out = np.empty(int(counts.sum()), np.int64)
        starts = np.cumsum(counts) - counts
        out[starts[plain]] = codes[: len(words)][plain]
        tail_codes = np.full(len(words), codes[len(words)])
        tail_codes[with_tail] = codes[len(words) + 1 : len(words) + 1 + len(tails)]
        out[starts[plain] + 1] = tail_codes[plain]
        out[gather(starts[~plain], counts[~plain])] = codes[len(words) + 1 + len(tails) :]
        return out, counts, pieces.dictionary

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after the other; how many each word has)."""
        codes, counts, pieces = self.pieces_of(words)
        starts, lengths = self.lookup(pieces)
        ids = self.ids[gather(starts[codes], lengths[codes])]
        before = np.concatenate(([0], np.cumsum(lengths[codes])))
        return ids, np.diff(before[np.concatenate(([0], np.cumsum(counts)))])


def piece_ids(path: str) -> PieceIds:
    cache = worker_cache()
    if ("piece ids", path) not in cache:
        cache["piece ids", path] = PieceIds(path)
    return cache["piece ids", path]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, words per text, the distinct words). Empty strings are no words."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    per_text = pc.list_value_length(lists).to_numpy().astype(np.int64)
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        real = codes != empty
        owner = np.repeat(np.arange(len(texts)), per_text)[real]
        codes, per_text = codes[real], np.bincount(owner, minlength=len(texts))
    return codes, per_text, coded.dictionary


def whole_tokenizer(path: str):
    """(the tokenizer as the library loads it, the names of its special tokens)."""
    from tokenizers import Tokenizer

    cache = worker_cache()
    if ("whole", path) not in cache:
        tokenizer = Tokenizer.from_file(path)
        names = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        cache["whole", path] = tokenizer, names
    return cache["whole", path]


def with_special(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_texts``, but names of special tokens in a text get their own ids.

    Texts that may hold such a name (in either case) are encoded whole by the library.
    """
    tokenizer, names = whole_tokenizer(path)
    texts = texts.fill_null("")
    holds = np.zeros(len(texts), bool)
    for name in names:
        found = pc.match_substring(texts, name, ignore_case=True)
        holds |= found.to_numpy(zero_copy_only=False)
    if not holds.any():
        return encode_texts(texts, path, end)
    ids, lengths = encode_texts(pc.if_else(pa.array(holds), "", texts), path, end)
    rows = np.flatnonzero(holds)
    encoded = tokenizer.encode_batch(
        texts.take(pa.array(rows)).to_pylist(), add_special_tokens=False
    )
    # Such a text was encoded as empty: its ids go in front of its end id.
    places = (np.cumsum(lengths) - lengths)[rows]
    more = np.array([len(e.ids) for e in encoded], np.int64)
    own = np.concatenate([np.array(e.ids, np.uint16) for e in encoded])
    lengths[rows] += more
    return np.insert(ids, np.repeat(places, more), own), lengths


def encode_texts(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each followed by ``end``; number of ids of each text).

    Names of special tokens are ordinary text.
    """
    codes, per_text, distinct = split_words(texts)
    flat, lengths = piece_ids(path).of_words(distinct)
    # The end id is one more word, behind the words of every text.
    flat, lengths = np.append(flat, np.uint16(end)), np.append(lengths, 1)
    starts = np.cumsum(lengths) - lengths
    pieces = np.full(len(codes) + len(texts), len(starts) - 1)
    stops = np.cumsum(per_text + 1)
    inner = np.ones(len(pieces), bool)
    inner[stops - 1] = False
    pieces[inner] = codes
    long = lengths[pieces]
    ids = flat[gather(starts[pieces], long)]
    before = np.concatenate(([0], np.cumsum(long)))
    return ids, np.diff(before[np.concatenate(([0], stops))])


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of about ``size`` bytes of text (one row at least)."""
    held, held_bytes = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        first = 0
        for row, length in enumerate(lengths):
            held_bytes += int(length)
            if held_bytes >= size:
                held.append(batch.slice(first, row + 1 - first))
                yield joined(held)
                held, held_bytes, first = [], 0, row + 1
        if first < len(lengths):
            held.append(batch.slice(first))
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
