"""Text columns as flat byte arrays: words, lines and hashes without a Python loop per word.

The functions here run inside Spark tasks (``mapInArrow``). A text column is cut
into blocks of whole texts of about ``BLOCK_BYTES``; each block is one byte array
with the offsets of its texts, so memory stays bounded by one block (or one very
long text) whatever the size of the table.

Word and line hashes are 64-bit polynomial hashes (mod 2**64) over random byte
values, finished with a bijective mixer. Two different words of one comparison
share a hash with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
# White space of the word pattern [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Letters and digits: ASCII ones, and every byte of a character outside ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[48:58] = LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_power = {"n": 0, "pow": np.ones(1, U), "inv": np.ones(1, U)}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _power["n"] < n:
        size = max(n, BLOCK_BYTES + 1)
        for key, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 2**64))):
            steps = np.full(size, U(base))
            steps[0] = U(1)
            _power[key] = np.multiply.accumulate(steps)
        _power["n"] = size
    return _power["pow"][:n], _power["inv"][:n]


class Block:
    """Some consecutive texts of a column: ``data`` bytes, ``offsets`` of the texts, ``first`` row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.n = len(offsets) - 1
        self._sums = None

    def lower(self) -> Block:
        """The block with A-Z lower-cased."""
        return Block(_LOWER[self.data], self.offsets, self.first)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of ``inside`` bytes; a run never crosses texts."""
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        heads = self.offsets[:-1][np.diff(self.offsets) > 0]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[heads] = False
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[heads[1:] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text index of the \\n-split lines (n newlines make n + 1 lines)."""
        cuts = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], cuts + 1])
        ends = np.concatenate([cuts, self.offsets[1:]])
        owner = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, cuts, side="right") - 1])
        order = np.lexsort((starts, owner))
        ends_owner = np.concatenate([owner[self.n:], np.arange(self.n)])
        return starts[order], ends[np.lexsort((ends, ends_owner))], owner[order]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range."""
        n = len(self.data)
        power, inverse = _powers(n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, U)
            np.cumsum(_VALUES[self.data] * power[:n], out=self._sums[1:])
        raw = (self._sums[ends] - self._sums[starts]) * inverse[starts]
        return mix64(raw ^ ((ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))

    def counts(self, mask: np.ndarray) -> np.ndarray:
        """Number of marked bytes in each text."""
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """``bounds`` with ``starts[bounds[i]:bounds[i + 1]]`` inside text i (starts ascending)."""
        return np.searchsorted(starts, self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.cast(pc.fill_null(pc.cast(column, pa.large_string()), ""), pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Whole texts of the column in blocks of about ``size`` bytes."""
    if not len(column):
        return
    data, offsets = flat(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        lo, hi = offsets[i], offsets[j]
        yield Block(data[lo:hi], offsets[i:j + 1] - lo, i)
        i = j


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles and the text index of each.

    A text with fewer than k words (at least one) has its whole sequence as one
    shingle; a text without words has none. ``bounds`` as from ``Block.owners``.
    """
    counts = np.diff(bounds)
    n = len(words)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    value = np.zeros(max(0, n - k + 1), U)
    for j in range(k if n >= k else 0):
        value = value * U(0x2545F4914F6CDD1D) + words[j:n - k + 1 + j]
    inside = owner[:n - k + 1] == owner[k - 1:] if n >= k else np.zeros(0, bool)
    out, who = mix64(value[inside]), owner[:n - k + 1][inside] if n >= k else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = []
        for i in short:
            h = U(int(counts[i]))
            with np.errstate(over="ignore"):
                for w in words[bounds[i]:bounds[i + 1]]:
                    h = h * U(0x2545F4914F6CDD1D) + w
            extra.append(h)
        out = np.concatenate([out, mix64(np.array(extra, U) ^ U(0x5DEECE66D))])
        who = np.concatenate([who, short])
        order = np.argsort(who, kind="stable")
        out, who = out[order], who[order]
    return out, who


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's ``long``."""
    return np.ascontiguousarray(x).view(np.int64)
