"""Numpy and Arrow helpers for operators that work on whole batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a piece of its own.
SLICE_BYTES = 2 << 20
#: Pieces that are encoded in one call.
ENCODE_ROWS = 10_000


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces whose texts hold about limit bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


class PieceIds:
    """Ids of pieces of text, each encoded once while it is remembered.

    Two generations are remembered: when the young one is full it becomes the old one, so
    pieces that keep coming back stay and others are forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], width: int, most: int = 250_000):
        self.encode, self.width, self.most = encode, width, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def each(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        parts = list(map(self.young.get, pieces))
        absent = [i for i, part in enumerate(parts) if part is None]
        missing = []
        for i in absent:
            parts[i] = part = self.old.get(pieces[i])
            if part is None:
                missing.append(i)
            else:
                self.young[pieces[i]] = part
        for start in range(0, len(missing), ENCODE_ROWS):
            some = missing[start : start + ENCODE_ROWS]
            words = [pieces[i] for i in some]
            for i, word, part in zip(some, words, self.encode(words), strict=True):
                parts[i] = self.young[word] = part
        return parts

    def joined(self, pieces: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of pieces, and where each text ends that ends after ends pieces."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        parts = pa.array(self.each(words), pa.large_binary())
        blob, stops = taken(parts, coded.indices)
        return blob.view(f"<u{self.width}"), stops[ends] // self.width


#: Classes of bytes: ASCII white space, letters, and all other ASCII (digits and signs).
BLANK, LETTER, SIGN = np.zeros((3, 256), bool)
BLANK[[*range(9, 14), 32]] = True
LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN[33:127] = ~LETTER[33:127]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts without nulls, and the offsets of its rows in them."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, "i8", len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, "i8")
    blob = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    return blob[ends[0] : ends[-1]], ends - ends[0]


def taken(values: pa.Array, codes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the large binary values that codes name, joined, and where each ends (0 first)."""
    return flat(values.take(pa.array(codes)))


def word_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut at some borders of their words, for patterns that part blanks, letters and signs.

    Cuts are before ASCII white space that follows other characters, and before an ASCII
    digit or sign after an ASCII letter.  A byte before white space that may end
    a character of Unicode's other white space keeps its piece whole.  A cut left out
    makes a longer piece and no other words.

    Returns the pieces of all texts side by side, and after how many of them each text
    ends (0 first).
    """
    blob, ends = flat(texts)
    if not len(blob):
        return pa.array([], pa.large_string()), np.zeros(len(ends), "i8")
    here = np.ones(len(blob), bool)
    here[1:] = BLANK[blob[1:]] & ~BLANK[blob[:-1]]
    at = np.flatnonzero(here[1:] & (blob[:-1] >= 0x80)) + 1
    last = blob[at - 1]
    odd = (last == 0x85) | (last == 0xA0)
    for lead in (0xE1, 0xE2, 0xE3):
        odd |= (blob[np.maximum(at - 3, 0)] == lead) & (at > 2)
    here[at[odd]] = False
    here[1:] |= SIGN[blob[1:]] & LETTER[blob[:-1]]
    here[ends[ends < len(blob)]] = True
    offsets = np.append(np.flatnonzero(here), len(blob))
    pieces = pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("i8")), pa.py_buffer(blob)]
    )
    return pieces, np.searchsorted(offsets, ends)
