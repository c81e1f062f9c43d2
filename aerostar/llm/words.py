"""Words of whole texts as 64-bit numbers, computed over Arrow buffers.

A word is a maximal run of bytes other than space and the control bytes 9 to
13 (``[^\\x20\\x09-\\x0D]+``; in UTF-8 these bytes only ever stand for
themselves). ``batches`` cuts a column of texts into groups of whole documents
of about ``CHUNK`` bytes, so the arrays below stay small whatever the size of
an Arrow batch. A single longer document is a group of its own.

Null texts count as empty; an empty text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U(27))
        x = x * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n reproducible 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + U(seed * 1_000_003)) * U(0x9E3779B97F4A7C15))


_BYTES = stream(1, 256)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE, _GRAM = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D  # odd, hence invertible modulo 2**64


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = (self._table(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        x = np.full(size, base, dtype=np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)


_byte_powers, _gram_powers = _Powers(_BASE), _Powers(_GRAM)


@dataclass
class Words:
    """Words of consecutive documents: document i has words
    ``docs[i]:docs[i+1]``; word j is ``data[starts[j]:ends[j]]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    hash: np.ndarray

    def text(self, i: int, j: int) -> list[bytes]:
        return [self.data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j])]


def batches(texts: pa.Array | pa.ChunkedArray, lower: bool = False,
            chunk: int = CHUNK) -> Iterator[tuple[int, int, Words]]:
    """(first row, one past the last row, their words) of each group."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # no chunk at all
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk, side="right")) - 1)
        j = min(j, n)
        yield i, j, split(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower)
        i = j


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    size = len(data)
    word = _IS_WORD[data]
    first = np.zeros(size + 1, dtype=bool)
    first[offsets] = True
    before = np.zeros(size, dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:size]))
    after = np.zeros(size, dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), spans(data, starts, [ends], lower)[0])


def spans(data: np.ndarray, starts: np.ndarray, ends: list[np.ndarray], lower: bool = False) -> list[np.ndarray]:
    """Hashes of the bytes from starts to each of several ends."""
    size = len(data)
    with np.errstate(over="ignore"):
        up, down = _byte_powers.get(max(size, 1))
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _BYTES)[data] * up[:size], out=total[1:])
        base, back = total[starts], down[starts]
        return [mix((total[e] - base) * back + (e - starts).astype(np.uint64)) for e in ends]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each place (len(hashes) - n + 1)."""
    size = len(hashes)
    if size < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up, down = _gram_powers.get(size)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(hashes * up, out=total[1:])
        return mix((total[n:] - total[:-n]) * down[:size - n + 1] + U(n))


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of n consecutive values, for each place."""
    if len(values) < n:
        return values[:0]
    width, out = 1, values
    while width * 2 <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    if width < n:
        rest = n - width
        out = np.minimum(out[:-rest], out[rest:])
    return out


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return hashes.view(np.int64)
