"""Words and shingles of texts as 64-bit hashes, computed with numpy per text.

A word is a run of bytes other than space, tab, newline, vertical tab, form
feed and carriage return; A-Z are lower-cased, nothing else. Its hash is a
polynomial over its bytes modulo 2^64, read from prefix sums over the whole
text, so the cost per byte is a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; longer texts are cut between words.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHasher:
    """Holds the tables of powers; one per task.

    ``separators`` are the bytes between words. With ``stems``, ``of`` returns
    the hashes of the words and of their first bytes, a row per length.
    """

    def __init__(self, separators: bytes = b" \t\n\x0b\x0c\r", stems: tuple[int, ...] = ()) -> None:
        self.stems = stems
        values = np.random.default_rng(20_24).integers(1, 1 << 63, 256, dtype=np.uint64)
        values[65:91] = values[97:123]
        self.values = values
        self.space = np.zeros(256, bool)
        self.space[list(separators)] = True
        self._grow(1 << 14)

    def _grow(self, size: int) -> None:
        def powers(base: int) -> np.ndarray:
            found = np.full(size, np.uint64(base))
            found[0] = 1
            return np.multiply.accumulate(found)

        self.powers, self.inverses = powers(_BASE), powers(_INVERSE)

    def _sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.powers):
            self._grow(1 << (len(data) - 1).bit_length())
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from every start to its end."""
        sums = self._sums(data)
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def _piece(self, data: np.ndarray) -> np.ndarray:
        outside = np.ones(len(data) + 2, bool)
        outside[1:-1] = self.space[data]
        edges = np.flatnonzero(outside[1:] != outside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = self._sums(data)
        stops = [ends, *(np.minimum(ends, starts + size) for size in self.stems)]
        found = [mixed((sums[stop] - sums[starts]) * self.inverses[starts]) for stop in stops]
        return np.stack(found) if self.stems else found[0]

    def of(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the words of one text, in order."""
        if len(data) <= PIECE:
            return self._piece(data)
        found, start = [], 0
        while start < len(data):
            end = start + PIECE
            if end < len(data):
                # Cut after the last space of the piece, or at the next one.
                spaces = np.flatnonzero(self.space[data[start:end]])
                if len(spaces):
                    end = start + int(spaces[-1]) + 1
                else:
                    later = np.flatnonzero(self.space[data[end:]])
                    end = end + int(later[0]) + 1 if len(later) else len(data)
            found.append(self._piece(data[start:end]))
            start = end
        return np.concatenate(found, axis=-1)

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Word hashes of every text of a column; none for a null."""
        for data in text_bytes(texts):
            yield self.of(data)


def text_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of every text, without copies; a null is empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(texts)):
        yield data[offsets[k] : offsets[k + 1]] if valid[k] else data[:0]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads the bits of every hash (splitmix64's finish)."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, in order; of fewer words, the whole
    sequence as one; of none, none."""
    count = len(words) - size + 1
    if count < 1:
        if not len(words):
            return words
        size, count = len(words), 1
    total = np.full(count, np.uint64(size))
    for k in range(size):
        total = total * np.uint64(_BASE) + words[k : k + count]
    return mixed(total)
