"""Operator 6: quality scores by a factorisation machine.

A text's features are its hashed words (logarithms of their counts, scaled to length 1), statistics of its
structure, and numbers among its metadata (by default the stated number of characters). The machine adds weights
and low-rank interactions of all pairs of features; by the identity

    sum over i<j of <v_i, v_j> x_i x_j = 1/2 * sum over f of ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

that takes time in proportion to a text's different words. It is fitted by AdaGrad on the log loss of a bounded
sample: the ``SAMPLE`` labelled rows of the training folds with the smallest hash of their id. Labels, languages, sources
and ids are never features. All texts are scored whole.

Defined results: a missing or empty text has no words and all-zero statistics, and gets a score like any other;
missing metadata counts as the text's own value; rows without a label are not learned from; several labels of
one id count as their smallest; without training rows every score is ``NO_MODEL``; rows are scored each, also if
ids repeat; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .langid import fold
from .words import Words, as_bytes, gram_hashes, lower_ascii, pieces, whole_runs

DIMENSIONS = 1 << 14
RANK = 8
SAMPLE = 6000
STEPS, BATCH = 400, 128  # updates, and rows in each
RATE = 0.05
DECAY = 1e-4
SEED = 6
THRESHOLD = 0.3
NO_MODEL = 0.5

# Classes of bytes whose shares of a text are features.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"#*$%&|<>", b"\"'()[]{}/\\@_-+=~^`", b"\n", b" "]
STATISTICS = len(CLASSES) + 9


def _of_words(words: Words, k: int, rows: int):
    """Text, hash and count of the different runs of ``k`` words."""
    at = whole_runs(words, k)
    h = gram_hashes(words.hashes(), k)[at] if len(at) else np.zeros(0, np.uint64)
    row = words.row[at]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], h[first], np.diff(np.append(first, len(h)))


def features(texts: list[bytes | None], meta: np.ndarray):
    """Words as (text, dimension, value), and one row of statistics and metadata per text."""
    rows = len(texts)
    texts = [t or b"" for t in texts]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(b"".join(texts), np.uint8)
    words = Words([lower_ascii(t) for t in texts])
    n = np.diff(words.first)
    row, h, count = _of_words(words, 1, rows)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=rows))
    shares = []
    for members in CLASSES:
        mask = np.zeros(256, dtype=bool)
        mask[list(members)] = True
        upto = np.append(0, np.cumsum(mask[data]))
        shares.append((upto[end] - upto[end - size]) / np.maximum(size, 1))
    most = np.zeros(rows)
    np.maximum.at(most, row, count)
    runs = np.bincount(_of_words(words, 3, rows)[0], minlength=rows)
    lines = [[x for x in t.split(b"\n") if x] for t in texts]
    n_lines = np.array([len(x) for x in lines])
    kept = np.array([len(set(x)) for x in lines])
    length = np.bincount(words.row, weights=words.end - words.start, minlength=rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, words.row, words.end - words.start)
    some = np.maximum(n, 1)
    table = np.stack(shares + [
        np.log1p(size), np.log1p(n), length / some, np.log1p(longest), most / some,
        np.bincount(row, minlength=rows) / some, np.where(n > 2, runs / np.maximum(n - 2, 1), 0.0),
        np.where(n_lines > 0, kept / np.maximum(n_lines, 1), 0.0), np.log1p(n_lines),
    ], axis=1)
    chars = np.array([len(t.decode("utf-8", "replace")) for t in texts])
    meta = np.where(np.isnan(meta), chars[:, None], meta)
    stated = np.sign(meta) * np.log1p(np.abs(meta))
    dimension = (h % np.uint64(DIMENSIONS)).astype(np.int64)
    return row, dimension, value / np.maximum(norm[row], 1e-9), np.hstack([table, stated])


class Machine:
    """Weights ``w`` and factors ``v`` of words, then of statistics, which are standardised."""

    def __init__(self, n_stats: int, seed: int = SEED):
        size = DIMENSIONS + n_stats
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (size, RANK))
        self.mean, self.spread = np.zeros(n_stats), np.ones(n_stats)

    def joined(self, row, dimension, value, stats):
        """Words and statistics as one list of (text, dimension, value), ordered by text."""
        rows, k = stats.shape
        z = np.clip((stats - self.mean) / self.spread, -4, 4) / 2
        row = np.concatenate((row, np.repeat(np.arange(rows), k)))
        dimension = np.concatenate((dimension, np.tile(DIMENSIONS + np.arange(k), rows)))
        order = np.argsort(row, kind="stable")
        return row[order], dimension[order], np.concatenate((value, z.ravel()))[order]

    def raw(self, row, dimension, value, rows: int):
        """Log odds, and the sums over features of each factor."""
        begin = np.searchsorted(row, np.arange(rows))  # every text has statistics
        vx = self.v[dimension] * value[:, None]
        sums = np.add.reduceat(vx, begin, axis=0)
        squares = np.add.reduceat((vx**2).sum(axis=1), begin)
        linear = np.add.reduceat(self.w[dimension] * value, begin)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def fit(self, row, dimension, value, stats, label) -> Machine:
        self.mean, self.spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
        row, dimension, value = self.joined(row, dimension, value, stats)
        rows = len(label)
        begin = np.searchsorted(row, np.arange(rows + 1))
        share = np.clip(label.mean(), 0.01, 0.99)
        self.bias = float(np.log(share / (1 - share)))
        past_w, past_v, past_b = np.full(self.w.shape, 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        order = np.random.default_rng(SEED)
        for _ in range(-(-STEPS * BATCH // rows)):
            mixed = order.permutation(rows)
            for at in range(0, rows, BATCH):
                some = mixed[at:at + BATCH]
                sizes = begin[some + 1] - begin[some]
                pick = np.repeat(begin[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                r, d, x = np.repeat(np.arange(len(some)), sizes), dimension[pick], value[pick]
                odds, sums = self.raw(r, d, x, len(some))
                wrong = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - label[some]) / len(some)
                e = (wrong[r] * x)[:, None]
                used, place = np.unique(d, return_inverse=True)
                grad_w, grad_v = np.zeros(len(used)), np.zeros((len(used), RANK))
                np.add.at(grad_w, place, e[:, 0])
                np.add.at(grad_v, place, e * (sums[r] - self.v[d] * x[:, None]))
                grad_w += DECAY * self.w[used]
                grad_v += DECAY * self.v[used]
                past_w[used] += grad_w**2
                past_v[used] += grad_v**2
                past_b += wrong.sum() ** 2
                self.w[used] -= RATE * grad_w / np.sqrt(past_w[used])
                self.v[used] -= RATE * grad_v / np.sqrt(past_v[used])
                self.bias -= RATE * wrong.sum() / np.sqrt(past_b)
        return self

    def scores(self, row, dimension, value, stats) -> np.ndarray:
        odds, _ = self.raw(*self.joined(row, dimension, value, stats), len(stats))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _features(batch: pa.RecordBatch):
    meta = np.array([c.to_pylist() for c in batch.column("meta").flatten()], dtype=np.float64).T
    return features(as_bytes(batch.column("text")), meta.reshape(batch.num_rows, -1))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text"):
        row, dimension, value, stats = _features(part)
        ends = np.cumsum(np.bincount(row, minlength=part.num_rows))[:-1]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("label"), pa.array([x.tolist() for x in np.split(dimension, ends)], pa.list_(pa.int64())),
             pa.array([x.tolist() for x in np.split(value, ends)], pa.list_(pa.float64())),
             pa.array(stats.tolist(), pa.list_(pa.float64()))],
            ["id", "label", "dimension", "value", "stats"],
        )


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Machine | None:
    """``docs`` has id, text, meta; ``labels`` id and label. The features of at most ``sample`` rows come to the driver."""
    chosen = labels.where(learn & F.col("label").isNotNull() & F.col("id").isNotNull()) \
        .groupBy("id").agg(F.min("label").alias("label")) \
        .join(docs.select("id").distinct(), "id", "leftsemi").orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("id", "label", "text", "meta")
    got = rows.mapInArrow(
        _extract, "id bigint, label double, dimension array<bigint>, value array<double>, stats array<double>"
    ).toArrow().sort_by("id")
    if not got.num_rows:
        return None
    lists = got.column("dimension").combine_chunks()
    row = np.repeat(np.arange(got.num_rows), lists.value_lengths().to_numpy())
    stats = np.array(got.column("stats").to_pylist())
    return Machine(stats.shape[1]).fit(
        row, lists.flatten().to_numpy(), got.column("value").combine_chunks().flatten().to_numpy(), stats,
        got.column("label").to_numpy(),
    )


def _score(machine: Machine | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            p = machine.scores(*_features(part)) if machine else np.full(part.num_rows, NO_MODEL)
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(p)], ["doc", "score"])

    return score


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text",
                  meta: tuple[str, ...] = ("n_chars",), label: str = "quality") -> DataFrame:
    """Every row's ``doc`` (without its text) and ``score``. ``learn`` is a condition on ``id`` of the labels."""
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"),
        F.col(id).cast("bigint").alias("id"), F.struct(*[F.col(c).cast("double").alias(c) for c in meta]).alias("meta"),
    )
    known = labels.select(F.col(id).cast("bigint").alias("id"), F.col(label).cast("double").alias("label"))
    machine = train(rows.select("id", "text", "meta"), known, learn)
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.select("doc", "text", "meta").mapInArrow(_score(machine), f"doc {kind}, score double")


def op6_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score_quality(docs, labels, fold(F.col("id"), 5) != 0)
    return out.select(
        F.col("doc.doc_id").alias("doc_id"), (fold(F.col("doc.doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
