"""Texts of an Arrow batch as arrays of bytes, words and hashes.

Used inside tasks by the operators that work on arrays. A batch is cut into
pieces of about a megabyte of text, so that memory does not follow the number of
rows in a batch; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be undone modulo 2**64
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LINE_FEED = 0x0A

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``BASE`` and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for value, put in ((BASE, "_powers"), (inverse, "_inverses")):
            all_powers = np.full(size, value, np.uint64)
            all_powers[0] = 1
            globals()[put] = np.cumprod(all_powers, dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with every bit spread over all bits."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


class Piece:
    """Some texts, one after the other: ``data`` bytes, text i from ``offsets[i]`` to ``offsets[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def in_word(self) -> np.ndarray:
        return ~IS_BLANK[self.data]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of bytes where ``inside`` holds; a run ends with its text."""
        before = np.empty(len(inside) + 1, bool)
        before[0], before[1:] = False, inside
        after = np.empty(len(inside) + 1, bool)
        after[-1], after[:-1] = False, inside
        before[self.offsets] = False
        after[self.offsets] = False
        return np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(self.in_word)

    @cached_property
    def word_offsets(self) -> np.ndarray:
        """The words of text i are those from ``word_offsets[i]`` to ``word_offsets[i + 1]``."""
        return np.searchsorted(self.words[0], self.offsets)

    @cached_property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.word_offsets))

    @cached_property
    def prefix_hash(self) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(len(self.data))[0], out=sums[1:])
        return sums

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans, by their content alone."""
        raw = (self.prefix_hash[ends] - self.prefix_hash[starts]) * powers(len(self.data) + 1)[1][starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * MIX_1)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.span_hashes(*self.words)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of ``size`` words: hash, first word, text. Windows do not cross texts."""
        hashes, texts = self.word_hashes, self.text_of_word
        n = max(len(hashes) - size + 1, 0)
        first = np.flatnonzero(texts[:n] == texts[size - 1:size - 1 + n]) if n else np.empty(0, np.int64)
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total = (total + hashes[i:i + n]) * BASE
        return mixed(total[first]), first, texts[first]

    def per_text(self, counts: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each text."""
        return segment_sums(counts, self.offsets)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring offsets; 0 for empty segments."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def pieces(texts: pa.Array | pa.ChunkedArray, size: int = PIECE_BYTES) -> Iterator[tuple[int, Piece]]:
    """The texts in pieces, each with the row it starts at. Nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, Piece(data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end
