"""Vectorised tokenising and hashing of many texts at once, for Arrow batches inside tasks.

A *word* here is a maximal run of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters. All non-ASCII
characters are word characters, so the work can be done on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else (b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256)
)
_MUL = 0x9E3779B97F4A7C15
_INV = pow(_MUL, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Bytes of text handled by one vectorised step; a longer text is a step of its own.
STEP_BYTES = 512 << 10
STEP_ROWS = 2048


def normalise(text: bytes) -> bytes:
    """Lower-case A-Z and turn every ASCII byte outside words into a space."""
    return text.translate(_TO_WORDS)


def text_steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """Slices ``[lo, hi)`` of a batch with their texts as bytes (null: empty), about ``STEP_BYTES`` each."""
    values = batch.column(column).cast(pa.binary()).to_pylist()
    lo, size = 0, 0
    for i, v in enumerate(values):
        size += len(v or b"")
        if size >= STEP_BYTES or i + 1 - lo >= STEP_ROWS:
            yield lo, i + 1, [x or b"" for x in values[lo : i + 1]]
            lo, size = i + 1, 0
    if lo < len(values):
        yield lo, len(values), [x or b"" for x in values[lo:]]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand."""
    prefix = np.empty(len(buf) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power(_MUL, len(buf)), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _power(_INV, len(buf) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of some texts: hashes, byte spans in ``buf``, and each text's range in ``ptr``."""

    def __init__(self, texts: list[bytes]):
        self.raw = normalise(b" ".join(texts) + b" ")
        self.buf = np.frombuffer(self.raw, np.uint8)
        inside = np.empty(len(self.buf) + 1, bool)
        inside[0] = False
        np.not_equal(self.buf, 32, out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        first_bytes = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.ptr = np.searchsorted(self.starts, first_bytes)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def count(self) -> np.ndarray:
        return np.diff(self.ptr)

    def joined(self, first: int, n: int) -> bytes:
        """The ``n`` words from ``first`` on, with single spaces."""
        return b" ".join(self.raw[self.starts[first] : self.ends[first + n - 1]].split())
