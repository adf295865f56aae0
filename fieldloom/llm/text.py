"""Whole batches of texts as byte arrays: words, word hashes and rolling hashes without a loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Batches are cut into pieces of about this many bytes, so memory does not follow the texts' sizes.
PIECE_BYTES = 1_000_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n + n // 4, PIECE_BYTES)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = []
        with np.errstate(over="ignore"):
            for base in (_BASE, inverse):
                steps = np.full(size, base, dtype=_U)
                steps[0] = 1
                _powers.append(np.cumprod(steps, dtype=_U))
    return _powers[0][:n], _powers[1][:n]


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together; a longer text is alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class Words:
    """The words of some texts: byte ranges in one buffer, and how many each text has."""

    def __init__(self, texts: list[bytes]):
        self.buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        space = (self.buf == 32) | ((self.buf >= 9) & (self.buf <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.start, self.text_start)
        self.count = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.count)
        self._sums: np.ndarray | None = None

    def hashes(self, values: np.ndarray | None = None, prefix: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes (its first ``prefix`` ones), or of ``values`` over its bytes (0: left out)."""
        v = self.buf.astype(_U) + _U(1) if values is None else values.astype(_U)
        up, down = powers(len(v))
        with np.errstate(over="ignore"):
            if values is None:
                if self._sums is None:
                    self._sums = np.concatenate(([_U(0)], np.cumsum(v * up, dtype=_U)))
                end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
                h = (self._sums[end] - self._sums[self.start]) * down[self.start]
            else:
                kept = v != 0
                at = np.concatenate(([0], np.cumsum(kept)))
                total = np.concatenate(([_U(0)], np.cumsum(v[kept] * up[: at[-1]], dtype=_U)))
                h = (total[at[self.end]] - total[at[self.start]]) * down[np.minimum(at[self.start], len(down) - 1)]
        return mix(h)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive values (len(h) - k + 1 of them, at least none)."""
    if len(h) < k:
        return np.zeros(0, dtype=_U)
    up, down = powers(len(h) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate(([_U(0)], np.cumsum(h * up[: len(h)], dtype=_U)))
        return mix((total[k:] - total[:-k]) * down[: len(h) - k + 1])


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list]:
    """Of lists of words: each word's number among the distinct ones, how many words each list has, and the distinct ones."""
    words = lists.flatten().dictionary_encode()
    return words.indices.to_numpy(), lists.value_lengths().to_numpy().astype(np.int64), words.dictionary.to_pylist()


def range_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the first counts[0] values, of the next counts[1], .."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], np.cumsum(counts)))])
