"""Vectorised word handling for Arrow batches of texts, used inside tasks.

Words are the maximal runs of characters other than ASCII white space, taken from the UTF-8 bytes of
whole texts. Batches are worked through in slices of about a megabyte, so memory doesn't depend on batch
size; one long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (public domain splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


mix = _splitmix
_BYTE = _splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), wrapping."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array that hold about ``limit`` bytes."""
    ends = np.cumsum([0] + [0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()])
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield at, stop
        at = stop


class Words:
    """The words of some texts: byte places, hashes and the text each belongs to."""

    def __init__(self, texts: list[bytes | None]):
        # a space after each text keeps words of neighbours apart
        self.data = b" ".join(t or b"" for t in texts) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        self.raw = raw
        lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        self.text_end = np.cumsum(lengths)
        gap = _SPACE[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(raw) and not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.text = np.searchsorted(self.text_end, self.start, "right")
        #: first word of each text, and one past the last text's last
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.start)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words joined by one space, and each word's place there; words i to j - 1 of a text are ``bytes[place[i] : place[j] - 1]``."""
        place = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.end - self.start + 1, out=place[1:])
        return b" ".join(self.data.split()), place

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            n = len(self.raw)
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_BYTE[self.raw] * _powers(_BASE, n), out=sums[1:])
            back = _powers(np.uint64(_inverse(int(_BASE))), n)
            return _splitmix((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64))


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; element i covers words i .. i + width - 1."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        base = _splitmix(np.array([seed + 17], np.uint64))[0] | np.uint64(1)
        sums = np.empty(len(h) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_splitmix(h + np.uint64(seed)) * _powers(base, len(h)), out=sums[1:])
        back = _powers(np.uint64(_inverse(int(base))), len(h))
        return _splitmix((sums[width:] - sums[:n]) * back[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    step, out = 1, x
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    if step < width:
        rest = width - step
        out = np.minimum(out[: len(out) - rest], out[rest:])
    return out
