"""Words of many texts as flat arrays, and 64-bit hashes of words and of runs of words.

Everything here works on one Arrow batch inside a task. Hashes only find candidates; callers
compare the bytes where a result hangs on equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, END = 32, 10
CHUNK_BYTES = 4 << 20
HASH_BYTES = 1 << 19

_ODD = 0x9E3779B97F4A7C15  # any odd number; the golden ratio in 64 bits
_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Everything in ASCII but digits and letters parts words; other bytes are kept.
_ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else SPACE
    for b in range(256)
)


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_ASCII_LOWER)


def lower_alnum(text: bytes) -> bytes:
    return text.translate(_ALNUM_LOWER)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of some texts, in order.

    ``data`` holds every text's words joined by one space and closed by a line feed; word ``i`` is
    ``data[start[i]:end[i]]`` of text ``row[i]``, and text ``r`` has words ``first[r]`` to
    ``first[r + 1]``. Words are parted by ASCII white space; a missing text has none.
    """

    def __init__(self, texts: list[bytes | None]):
        self._place(b"\n".join([b" ".join(t.split()) if t else b"" for t in texts] + [b""]), len(texts))

    @classmethod
    def of_lines(cls, data: bytes) -> Words:
        """From what another one has as ``data``, or whole lines of it."""
        words = cls.__new__(cls)
        words._place(data, data.count(b"\n"))
        return words

    def _place(self, data: bytes, texts: int) -> None:
        self.data = data
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)
        ends = np.flatnonzero((self.bytes == SPACE) | (self.bytes == END))
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        text_of = np.cumsum(self.bytes[ends] == END) - (self.bytes[ends] == END)
        full = ends > starts
        self.start, self.end, self.row = starts[full], ends[full], text_of[full]
        self.first = np.searchsorted(self.row, np.arange(texts + 1))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """Hash of every word: a polynomial of its bytes. Works on ``HASH_BYTES`` of text at a time."""
        out = np.empty(len(self), dtype=np.uint64)
        a = 0
        while a < len(self):
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + HASH_BYTES, side="right")))
            base, stop = self.start[a], self.end[b - 1]
            start, end = self.start[a:b] - base, self.end[a:b] - base
            place = np.arange(stop - base) - np.repeat(start, np.diff(np.append(start, stop - base)))
            terms = _powers(int(place.max()) + 1)[place]
            terms *= self.bytes[base:stop].astype(np.uint64) + np.uint64(1)
            sums = np.cumsum(terms)
            out[a:b] = sums[end - 1] - np.where(start > 0, sums[start - 1], np.uint64(0))
            a = b
        return mix(out)

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last``, both included, of one text."""
        return self.data[self.start[first]:self.end[last]]


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` numbers, by putting together runs of powers of two."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, run, size, factor = None, 0, h, 1, _ODD
    while size <= k:
        if k & size:
            part = run[done:done + n]
            out = part if out is None else out * np.uint64(factor) + part
            done += size
        if size * 2 <= k:
            run = run[:-size] * np.uint64(factor) + run[size:]
        size, factor = size * 2, factor * factor % 2**64
    return mix(out)


def sliding_min(h: np.ndarray, k: int) -> np.ndarray:
    """Smallest of every run of ``k`` numbers."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    size = 1
    while size * 2 <= k:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[k - size:k - size + n])


def whole_runs(words: Words, k: int) -> np.ndarray:
    """First words of the runs of ``k`` words that lie in one text."""
    n = max(0, len(words) - k + 1)
    return np.flatnonzero(words.row[:n] == words.row[k - 1:k - 1 + n])


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most about ``size`` bytes of text; one text is never cut."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        upto = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, done + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def spans_covered(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``length`` words that begins at one of ``first``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + length, n), -1)
    return np.cumsum(change[:-1]) > 0
