"""Operator 13: periodic runs of words by an online sparse dynamic programme over diagonals.

A run is a stretch of words with smallest period q and a length of at least max(6, 4 q) that cannot be made longer on
either side. ``runs_of`` goes through a text's words in order. Every active lag p has a match length: a word that equals
the one p before increments it, any other ends the diagonal, and if that was long enough the run is emitted at once.

A diagonal per earlier occurrence of every word would be the square of a frequent word's count, so lags are sparse:
one becomes active only where it can end as a run. A run of period p from K to 2K - 1, K a power of two, has 3K - 1
matches or more in a row. Those hold a block of 2K words that begins at a multiple of K, and is equal to the block p words
earlier. Blocks have names (equal names for equal blocks of one text, made by doubling: a block of 2K is a pair of
blocks of K), kept only for blocks that their text has twice. So each K costs one comparison per word at
most, whatever the words. A lag whose p words are themselves a repetition is no smallest period; names of blocks tell that
too. What is left are few lags per word (squares of words that are no repetitions), and walks
that end early.

Names are made for all texts of a slice at once; texts cannot match each other, since names count in one text only.

Defined results: a missing or blank text has no words and no runs; repeated rows are judged each; an empty table gives
an empty one. Added columns come beside the row in ``doc``, so names cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import as_bytes, pieces

LEAST, TIMES = 6, 4  # a run has at least LEAST words and TIMES periods
SLICE_BYTES = 2 << 20
CELLS = 1 << 20  # of comparisons at a time


def _next_names(names: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """Names of blocks of ``2 * size`` words from those of ``size``; -1 where the text has a block but once."""
    out = np.full(len(names), -1, dtype=np.int64)
    at = np.flatnonzero(names[:len(names) - size] >= 0) if len(names) > size else np.zeros(0, dtype=np.int64)
    at = at[(names[at + size] >= 0) & (row[at] == row[at + size])]
    out[at] = _twice(names[at] * (len(names) + 1) + names[at + size])
    return out


def _twice(keys: np.ndarray) -> np.ndarray:
    """Equal numbers for equal keys, -1 for a key that is there once."""
    if not len(keys):
        return keys
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[name] > 1, name, -1)


def _word_names(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Names of single words within their text."""
    return _twice(row * (int(words.max(initial=0)) + 1) + words)


class _Primes:
    """Smallest prime factors of numbers, as far as they were needed."""

    def __init__(self):
        self.least = np.arange(2)

    def upto(self, most: int) -> np.ndarray:
        if most >= len(self.least):
            least = np.arange(2 * most + 2)
            for p in range(2, int(len(least) ** 0.5) + 1):
                if least[p] == p:
                    some = least[p * p::p]
                    some[some == np.arange(p * p, len(least), p)] = p
            self.least = least
        return self.least


_primes = _Primes()


def _repetition(levels: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether the ``lag`` words before ``at`` are a shorter stretch several times."""
    least, found, rest = _primes.upto(int(lag.max(initial=1))), np.zeros(len(at), dtype=bool), lag.copy()
    while True:
        todo = np.flatnonzero((rest > 1) & ~found)
        if not len(todo):
            return found
        prime = least[rest[todo]]
        step = lag[todo] // prime
        # The words before ``at`` but for the first ``step`` equal those but for the last: two blocks cover them.
        first, size = at[todo] - lag[todo], lag[todo] - step
        level = np.frexp(size.astype(np.float64))[1] - 1
        equal = np.zeros(len(todo), dtype=bool)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            names, last = levels[k], first[own] + size[own] - (1 << k)
            a, b = names[first[own]], names[last]
            equal[own] = (a >= 0) & (b >= 0) & (a == names[first[own] + step[own]]) & (b == names[last + step[own]])
        found[todo] = equal
        rest[todo] //= prime
        while True:
            again = todo[rest[todo] % prime == 0]
            if not len(again):
                break
            same = rest[todo] % prime == 0
            rest[todo[same]] //= prime[same]


def candidates(words: np.ndarray, row: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which a diagonal may become a run: equal blocks, and no repetition as period.

    ``longest`` is the number of words of the longest text.
    """
    places, lags, levels, size = [], [], [_word_names(words, row)], 1
    while TIMES * size <= longest and (levels[-1] >= 0).any():
        names = _next_names(levels[-1], row, size)
        levels.append(names)
        at = np.arange(0, len(names), size)
        at = at[names[at] >= 0]
        step = max(1, CELLS // size)
        for some in (at[i:i + step] for i in range(0, len(at), step)):
            before = some[:, None] - np.arange(size, 2 * size)
            i, j = np.nonzero((before >= 0) & (names[np.maximum(before, 0)] == names[some][:, None]))
            place, lag = some[i], j + size
            new = ~_repetition(levels, place, lag)
            places.append(place[new])
            lags.append(lag[new])
        size *= 2
    if not places:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    return np.concatenate(places), np.concatenate(lags)


def runs_of(words: list[int], places: list[int], lags: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period, given where lags may begin."""
    begin: dict[int, set[int]] = {}
    reached: dict[int, int] = {}  # by lag, how far back a walk has to go
    for place, lag in sorted(zip(places, lags)):
        at, stop = place, max(lag, reached.get(lag, 0))
        while at > stop and words[at - 1] == words[at - 1 - lag]:
            at -= 1
        reached[lag] = place
        if at == stop and stop > lag and words[at - 1] == words[at - 1 - lag]:
            continue  # goes on from a place that was there before
        begin.setdefault(at, set()).add(lag)
    found, active, at, n = [], {}, 0, len(words)
    starts = sorted(begin)
    for k, at in enumerate(starts):
        upto = starts[k + 1] if k + 1 < len(starts) else n + 1
        for lag in begin[at]:
            active.setdefault(lag, 0)
        while active and at < upto:
            ended = [lag for lag in active if at == n or words[at] != words[at - lag]]
            for lag in ended:
                length = active.pop(lag) + lag
                if length >= max(LEAST, TIMES * lag):
                    found.append((at - length, length, lag))
            for lag in active:
                active[lag] += 1
            at += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on, and with which period, the words of a tenth of the documents repeat."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(b"%d" % doc_id)
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _digest(runs: list[tuple[int, int, int]], words: list[bytes]) -> tuple[bytes, bytes]:
    """The list of runs as text, and the words that no run holds after its first period."""
    listed = b"".join(b"%d,%d,%d\n" % r for r in runs)
    kept, upto = [], 0
    for first, end in sorted((start + period, start + length) for start, length, period in runs):
        if end > upto:
            kept += words[upto:max(first, upto)]
            upto = end
    return listed, b" ".join(kept + words[upto:])


def _greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for r in runs:  # by start and period, so the first of equal ones counts
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _find(plant: Callable | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", SLICE_BYTES):
            texts = [t.split() if t else [] for t in as_bytes(part.column("text"))]
            if plant:
                for r, id in enumerate(part.column("id").to_pylist()):
                    if (put := plant(id, len(texts[r]))) is not None:
                        a, p = put
                        w = texts[r]
                        texts[r] = w[:a] + [w[a + k % p] for k in range(len(w) - a)]
            known: dict[bytes, int] = {}
            numbers = [[known.setdefault(w, len(known)) for w in t] for t in texts]
            size = np.array([len(t) for t in texts], dtype=np.int64)
            first = np.cumsum(size) - size
            row = np.repeat(np.arange(len(texts)), size)
            flat = np.fromiter((x for t in numbers for x in t), np.int64, int(size.sum()))
            place, lag = candidates(flat, row, int(size.max(initial=0)))
            own = row[place]
            order = np.argsort(own, kind="stable")
            place, lag, own = place[order], lag[order], own[order]
            cut = np.searchsorted(own, np.arange(len(texts) + 1))
            out: list[list] = [[] for _ in range(9)]
            for r, words in enumerate(texts):
                a, b = cut[r], cut[r + 1]
                runs = runs_of(numbers[r], (place[a:b] - first[r]).tolist(), lag[a:b].tolist()) if a < b else []
                best = _greatest(runs)
                listed, kept = _digest(runs, words)
                milli = 1000 * best[1] // best[2] if best else None
                for column, value in zip(out, (len(words), [dict(zip(("start", "length", "period"), x)) for x in runs],
                                               *(best or (None, None, None)), milli, kept.decode(),
                                               hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())):
                    column.append(value)
            kinds = [pa.int64(), RUN, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["doc", "n_words", "runs", "start", "length", "period", "exponent_milli", "collapsed",
                 "runs_sha256", "collapsed_sha256"])

    return find


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, text: str = "text", id: str | None = None,
                  plant: Callable | None = None) -> DataFrame:
    """Every row's ``doc`` (without its text), ``n_words``, ``runs``, ``start``, ``length``, ``period`` and
    ``exponent_milli`` of the one with the most periods, ``collapsed`` (the words left when every run keeps its first
    period), ``runs_sha256`` and ``collapsed_sha256``.

    ``plant`` gives, for an id and a number of words, from where on and how long a stretch repeats, or None.
    """
    rest = [c for c in docs.columns if c != text]
    doc = F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(doc.alias("doc"), F.col(text).alias("text"),
                       (F.col(id).cast("bigint") if id else F.lit(None).cast("bigint")).alias("id"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_find(plant), f"""
        doc {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>,
        start bigint, length bigint, period bigint, exponent_milli bigint, collapsed string,
        runs_sha256 string, collapsed_sha256 string""")


def op13_periodic(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return periodic_runs(docs, id="doc_id", plant=planted).select(
        F.col("doc.doc_id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "start", "length", "period",
        "exponent_milli", "runs_sha256", "collapsed_sha256")
