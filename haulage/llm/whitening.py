"""Operator 11: whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers x = floor(1024 c) + 100000, so that sums are exact and every centred row is rounded once.
The centred rows form a matrix A, which is never gathered:

1. Every pass adds up the Gram matrix of A R^-1 in the tasks, whose rows go through triangular solves with the factors
   found so far. The first pass has R = 1; the Cholesky factor of its Gram matrix is shifted, so that it exists
   however ill-conditioned A is. Each further factor makes the columns more orthogonal.
2. When the Gram matrix is the identity on all directions that A has, the composed R holds all of A's singular
   values, to double precision and not to that of A'A. The last Gram matrix G gives B = G^(1/2) R with B'B = A'A.
3. The singular value decomposition of B (as wide as a vector) gives the components and e = s^2 / n.
4. One more pass measures the covariance of what came out.

Only sums of the width of a vector, and its square, come to the driver; the table is read once per pass (seven times in
all for well-behaved data).

Defined results: rows whose vector is missing, or holds a missing or non-finite entry, are left out. So are rows whose
vector is not as long as most are (of equally frequent lengths the longest counts). x is held within 2^50 on either side.
Directions without spread (singular values below 1e-11 of the largest) are no components, so there may be fewer than
asked for; without any, as in a table of equal rows or one row, rows have empty ``whitened``. A ``deviation`` beyond
64 bits is missing. Repeated rows count each. An empty table gives an empty one. Added columns come beside the row in
``doc``, so names cannot clash. Components are turned so that their largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, WIDEST = 1024, 100_000, 1 << 50
COMPONENTS = 8
PASSES = 12  # at most; three are enough unless singular values lie 10^5 apart
FLAT = 1e-11  # of the largest singular value
ENTRIES = 1 << 19  # of vectors worked on at a time
UNIT = np.finfo(np.float64).eps / 2


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and finite, with it as ``v`` beside ``doc`` (the rest of the row)."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rest = [c for c in rows.columns if c != vector]
    doc = F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))
    return rows.where(v.isNotNull() & finite).select(doc.alias("doc"), v.alias("v"))


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * flat) + OFFSET, -WIDEST, WIDEST).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some rows at a time, with their x."""
    step = max(1, ENTRIES // width)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            flat = part.column(part.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield part, whole_numbers(flat).reshape(-1, width)


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums of x: each is ``n * base + rest`` with rest from 0 to n - 1."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exact; None beyond 64 bits."""
        off = x - self.base
        largest = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if largest**2 * x.shape[1] < 1 << 63:
            scaled = off * self.n - self.rest
            return (scaled * scaled).sum(axis=1).tolist()
        scaled = off.astype(object) * self.n - self.rest.astype(object)
        sums = [sum(v * v for v in row) for row in scaled]
        return [s if s < 1 << 63 else None for s in sums]


def _centre(table: DataFrame, width: int) -> Centre:
    # Sums of the high and the low bits of x, so that neither can overflow.
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for _, x in _parts(batches, width):
            n += len(x)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array([n] * width), pa.array(high), pa.array(low)],
                ["j", "n", "high", "low"])

    sums = table.select("v").mapInArrow(add, "j bigint, n bigint, high bigint, low bigint") \
        .groupBy("j").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("j").collect()
    n = sums[0].n
    parts = [divmod((r.high << 26) + r.low, n) for r in sums]
    return Centre(n, np.array([p[0] for p in parts]), np.array([p[1] for p in parts]))


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a R^-1 for an upper triangular R, one column after the other."""
    out = np.empty(a.shape, order="F")
    for j in range(a.shape[1]):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _gram(table: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of q'q over all rows, where ``of`` makes rows q of ``size`` numbers from rows of x."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((size, size)), 0
        for _, x in _parts(batches, width):
            q = of(x)
            total += q.T @ q
            n += len(x)
        if n:
            i, j = np.divmod(np.arange(size * size), size)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "g"])

    out = np.zeros((size, size))
    for r in table.select("v").mapInArrow(add, "i bigint, j bigint, g double") \
            .groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        out[r.i, r.j] = r.g
    return (out + out.T) / 2


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R'R = gram + shift, the shift raised until it exists."""
    for _ in range(20):
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, UNIT * np.trace(gram))
    raise ValueError("no Cholesky factor of the Gram matrix")


def orthogonalise(gram_of: Callable[[list[np.ndarray]], np.ndarray], n: int, width: int) -> np.ndarray:
    """B with B'B = A'A, from Gram matrices of A R1^-1 R2^-1 ... for the factors so far."""
    factors: list[np.ndarray] = []
    for _ in range(PASSES):
        gram = gram_of(factors)
        if not factors and not gram.any():
            return gram
        values, vectors = np.linalg.eigh(gram)
        live = values > 1e-6
        if factors and (np.abs(values[live] - 1) < 1e-10).all() and (values[~live] < 1e-12).all():
            break
        # The shift of the first pass bounds the condition of what it leaves; later ones are as small as can be.
        amount = 11 * (n * width + width * (width + 1)) * UNIT if not factors else width * UNIT
        factors.append(_factor(gram, min(amount, 1e-3) * np.trace(gram)))
    composed = np.eye(width)
    for r in factors:
        composed = r @ composed
    return np.sqrt(np.maximum(values, 0))[:, None] * (vectors.T @ composed)


@dataclass(frozen=True)
class Whitening:
    """The fitted map: row x gives ``(x - S/n) @ turn``."""

    width: int
    centre: Centre | None
    turn: np.ndarray
    explained: list[float]
    identity_error: float

    @property
    def n(self) -> int:
        return self.centre.n if self.centre else 0


def fit(table: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit to all rows of ``usable``."""
    lengths = table.groupBy(F.size("v").alias("width")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    if common is None or not common.width:
        return Whitening(0, None, np.zeros((0, 0)), [], 0.0)
    width = common.width
    table = table.where(F.size("v") == width)
    centre = _centre(table, width)

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            q = centre.rows(x)
            for r in factors:
                q = solve(q, r)
            return q

        return _gram(table, width, of, width)

    spread = orthogonalise(gram_of, centre.n, width)
    _, s, turned = np.linalg.svd(spread)
    k = min(components, int((s > FLAT * s[0]).sum())) if s[0] > 0 else 0
    axes = turned[:k].T
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(k)])
    turn = axes * (centre.n ** 0.5 / s[:k])
    explained = (s[:k] ** 2 / (s ** 2).sum()).tolist()
    error = 0.0
    if k:
        def with_one(x: np.ndarray) -> np.ndarray:
            return np.column_stack([centre.rows(x) @ turn, np.ones(len(x))])

        moments = _gram(table, width, with_one, k + 1) / centre.n
        covariance = moments[:k, :k] - np.outer(moments[:k, k], moments[:k, k])
        error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(width, centre, turn, explained, error)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening]:
    """Every usable row's ``doc`` (without its vector), ``deviation`` and ``whitened`` (one number per component), and
    what was fitted."""
    table = usable(rows, vector)
    model = fit(table, components)
    centre, turn, width = model.centre, model.turn, model.width

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _parts(batches, width) if width else ():
            out = centre.rows(x) @ turn
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1])
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc")), pa.array(centre.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(out).ravel()))],
                ["doc", "deviation", "whitened"])

    kind = table.schema["doc"].dataType.simpleString()
    out = table.where(F.size("v") == width).mapInArrow(
        turned, f"doc {kind}, deviation bigint, whitened array<double>")
    return out, model


def op11_whitening(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out, model = whiten(rows)
    explained = F.get(F.array(*map(F.lit, model.explained)), F.col("component")) if model.explained else F.lit(None)
    return out.select(F.col("doc.vec_id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("component", "w")) \
        .select("vec_id", (F.col("component") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                "deviation", F.col("w").alias("whitened"), explained.cast("double").alias("explained"),
                F.lit(model.identity_error).alias("identity_error"))
