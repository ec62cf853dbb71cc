"""Word and shingle hashing over Arrow batches, vectorised with numpy.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``. UTF-8 continuation and
lead bytes are never one of those six blanks, so words of the bytes are the
words of the characters.

A word's 64-bit hash is a polynomial over a random byte table, taken from one
prefix sum over the whole block (no Python call per word), then mixed. Equal
words have equal hashes everywhere: tables and constants come from one seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_TABLE = _rng.integers(0, 2**64, 256, dtype=_U)
GRAM = _rng.integers(0, 2**64, 64, dtype=_U) | _U(1)
_BASE = int(_rng.integers(0, 2**63, dtype=_U)) * 2 + 1
_BASE_INV = pow(_BASE, -1, 2**64)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes outside letters, for texts already in lower case: other ASCII.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[97:123] = False
NOT_LETTER[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled at once. Only temporary arrays depend on it.
BLOCK_BYTES = 1 << 19
_pow = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            a = np.full(size, base, _U)
            a[0] = 1
            _pow[name] = np.multiply.accumulate(a)
    return _pow["up"][:n], _pow["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_spans(buf: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte array."""
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = ~blank[buf]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_spans(values, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the spans of a sequence; ``values(a, b)`` gives the random
    64-bit values of its elements. Works in slices cut between spans, so
    temporary arrays stay near ``BLOCK_BYTES`` elements whatever the text."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _powers(b - a)
        run = np.zeros(b - a + 1, _U)
        np.cumsum(values(a, b) * up, out=run[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (run[e] - run[s]) * down[s] + (e - s).astype(_U) * GRAM[0]
        i = j
    return mix(out)


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_spans(lambda a, b: BYTE_TABLE[buf[a:b]], starts, ends)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word runs of a word hash array; empty when shorter."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, _U)
    out = h[:m] * GRAM[1]
    for k in range(1, n):
        out = out + h[k:k + m] * GRAM[1 + k]
    return mix(out)


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingles; a shorter text is one shingle of all
    its words, a text without words has none."""
    if not len(h):
        return np.empty(0, _U)
    return np.unique(grams(h, min(n, len(h))) if len(h) >= n else
                     grams(h, len(h)) + _U(len(h)))


class Block:
    """Words of some texts: ``at[i]:at[i+1]`` are text ``i``'s words in ``h``,
    ``starts`` and ``ends`` (offsets into ``raw``)."""

    def __init__(self, rows: range, texts: list[bytes], lower: bool, blank: np.ndarray):
        self.rows = rows
        self.raw = b"\n".join(texts)
        buf = np.frombuffer(self.raw, np.uint8)
        if lower:
            buf = LOWER[buf]
        self.buf = buf
        self.starts, self.ends = word_spans(buf, blank)
        self.h = hash_words(buf, self.starts, self.ends)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.at = np.searchsorted(self.starts, begin)

    def docs(self) -> Iterator[tuple[int, np.ndarray]]:
        for k, row in enumerate(self.rows):
            yield row, self.h[self.at[k]:self.at[k + 1]]


def small(batches, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of at most ``rows`` rows, so that only a slice is
    ever unpacked to Python objects; gives unused memory back at the end."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()


def text_bytes(col) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, nulls as empty."""
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], lower: bool = False, blank: np.ndarray = BLANK) -> Iterator[Block]:
    """Consecutive texts of about ``BLOCK_BYTES`` together; one longer text is
    a block of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK_BYTES:
            yield Block(range(first, i), texts[first:i], lower, blank)
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield Block(range(first, len(texts)), texts[first:], lower, blank)
