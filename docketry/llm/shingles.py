"""Sets of five-word shingles as 64-bit numbers, for many texts at once.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, with A-Z lowered. A
text of one to four words has its whole sequence as the only shingle; one without words has an empty set. Numbers are
polynomial sums over bytes and then words, mixed; two different shingles of a pair of documents share one with a
chance of about 2^-64 times the number of their pairs, which is left out of account. A set's key is a 128-bit
digest of its sorted numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

SIZE = 5
#: Bytes of text that one pass of the array code takes (a longer text makes a pass of its own).
PASS_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Keeps the tables of powers between passes."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)
        rng = np.random.default_rng(5)
        self.factors = rng.integers(1, 1 << 63, SIZE, dtype=np.uint64) | np.uint64(1)
        self.short = rng.integers(1, 1 << 63, SIZE, dtype=np.uint64)

    def sets(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct numbers of each text."""
        run: list[bytes] = []
        size = 0
        for text in texts:
            data = text.encode("utf-8", "surrogatepass") if text else b""
            if run and size + len(data) > PASS_BYTES:
                yield from self._pass(run)
                run, size = [], 0
            run.append(data)
            size += len(data) + 1
        if run:
            yield from self._pass(run)

    def _pass(self, run: list[bytes]) -> Iterator[np.ndarray]:
        flat = _LOWER[np.frombuffer(b"\n".join(run) + b"\n", np.uint8)]
        if len(self.up) < len(flat) + 1:
            self.up, self.down = _powers(_BASE, len(flat) + 1), _powers(_INVERSE, len(flat) + 1)
        solid = ~_BLANK[flat]
        edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * self.up[: len(flat)], out=sums[1:])
        word = mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        # Words of text i are first[i] up to first[i + 1].
        ends = np.cumsum(np.fromiter(map(len, run), np.int64, len(run)) + 1)
        first = np.concatenate(([0], np.searchsorted(start, ends)))
        n = max(len(word) - SIZE + 1, 0)
        shingle = np.zeros(n, np.uint64)
        for i, factor in enumerate(self.factors):
            shingle += word[i : i + n] * factor
        shingle = mix(shingle)
        for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if e - s >= SIZE:
                yield np.unique(shingle[s : e - SIZE + 1])
            elif e > s:
                few = word[s:e] * self.factors[: e - s]
                yield mix(few.sum(dtype=np.uint64, keepdims=True) + self.short[e - s - 1])
            else:
                yield np.zeros(0, np.uint64)


def set_key(numbers: np.ndarray) -> bytes:
    return hashlib.blake2b(numbers.astype("<u8").tobytes(), digest_size=16).digest()
