"""Words of Arrow texts as codes, cut by byte classes in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE, BREAK = 1, 2


def byte_classes(space: bytes, breaks: bytes = b"") -> np.ndarray:
    """The class of each byte: part of a word, white space, or the end of a piece."""
    classes = np.zeros(256, np.uint8)
    classes[list(space)] = SPACE
    classes[list(breaks)] = BREAK
    return classes


@dataclass
class Words:
    """All words of some texts: their codes into ``distinct``, their text, and their piece."""

    codes: np.ndarray
    text: np.ndarray
    piece: np.ndarray
    distinct: pa.StringArray


def scan(texts: pa.StringArray, classes: np.ndarray) -> Words:
    """Cut texts (null: empty) into words, with A to Z lowered. Bytes of a character beyond ASCII
    are all part of words, so no character is cut."""
    texts = texts.fill_null("")
    _, starts, data = texts.buffers()
    starts = np.frombuffer(starts, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[starts[0] : starts[-1]]
    starts = starts - starts[0]
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    kind = classes[raw]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(raw)]
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    # Without what separates them, the words lie side by side.
    offsets = np.append((np.cumsum(inside, dtype=np.int32) - 1)[begin], inside.sum()).astype(np.int32)
    packed = pa.StringArray.from_buffers(
        len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(lower[raw[inside]]))
    )
    coded = packed.dictionary_encode()
    return Words(
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.searchsorted(starts, begin, side="right") - 1,
        np.cumsum(kind == BREAK, dtype=np.int32)[begin],
        coded.dictionary,
    )
