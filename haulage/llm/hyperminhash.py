"""Operator 5: near-duplicate documents by HyperMinHash.

A document is the set of its runs of ``SHINGLE`` words (a parameter), lower-cased in ASCII. Linked are documents whose sets have a
Jaccard similarity of 0.8 or more; groups are the connected components of links.

1. *Sketch.* Every shingle falls into one of ``REGISTERS`` buckets, which keeps its smallest hash as a
   leading-zero count and ``MANTISSA`` bits, 16 bits in all. Empty buckets borrow from a full one found by
   a walk that is the same for all documents, so that registers of two documents agree with the
   probability of their similarity, also in short ones.
2. *Copies.* Documents with equal sets (128-bit sums over the shingles) are one class, under its smallest id.
3. *Bands.* ``BANDS`` bands of ``ROWS`` registers; two similar classes miss all of them with
   probability (1 - 0.8^7)^56 = 2e-6 at the limit and less above it.
4. *Stars.* In every bucket each class is compared with the bucket's smallest one: as many pairs as members,
   however large the bucket.
   Pairs go through the size filter, then the estimate from ``ESTIMATED`` registers, corrected for chance
   collisions, kept if no more than 5 standard deviations below 0.8, then an exact comparison of the sets of words.
5. *The rest.* After the components of those links are known, only buckets that hold several components can
   hide a link. Per component of smallest ones, the classes outside it are compared with all that share such buckets, in
   blocks of bounded size: shares of both sides meet in a task with their sets, and an inverted index counts the
   intersections. A block gives at most one link for each class and component, however many pairs it compares; the
   sets of words confirm it.

Texts are only shuffled for candidate pairs. Defined results: a missing or blank text has an empty set and is
linked with nothing; fewer words than a shingle's are one by themselves; rows that share an id count as one document
with the links of each (their ``n_shingles`` are their own); a missing id has no component and is kept; ids that are no
whole numbers end the query; an empty table gives an empty one. ``keep_first`` numbers the rows, so that ids may
be anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .links import components
from .shared import Scratch, small, written
from .words import Words, as_bytes, gram_hashes, lower_ascii, mix, pieces, whole_runs
from .workers import lean

SHINGLE = 2
BANDS, ROWS = 56, 7
REGISTERS = 397  # a prime over BANDS * ROWS, so that every walk visits all registers
MANTISSA = 10
ESTIMATED = 128
PERCENT = 80
DEVIATIONS = 5
LEFT_SHINGLES, RIGHT_SHINGLES = 32_000, 128_000  # of a share in one block

_SALT = [np.uint64(s * 0x9E3779B97F4A7C15 % 2**64) for s in range(1, 6)]


def shingle_hashes(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every different shingle, ordered by text and hash."""
    h, n = words.hashes(), np.diff(words.first)
    whole = whole_runs(words, size)
    row, sh = [words.row[whole]], [gram_hashes(h, size)[whole] if len(whole) else h[:0]]
    for few in range(1, size):
        at = words.first[:-1][n == few]
        row.append(words.row[at])
        sh.append(mix(gram_hashes(h, few)[at] ^ _SALT[4]) if len(at) else h[:0])
    row, sh = np.concatenate(row), np.concatenate(sh)
    order = np.lexsort((sh, row))
    row, sh = row[order], sh[order]
    new = np.ones(len(sh), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (row[1:] != row[:-1])
    return row[new], sh[new]


def registers(row: np.ndarray, sh: np.ndarray, rows: int) -> np.ndarray:
    """Sketches: for each text the registers as 16-bit numbers, all 0 for an empty set."""
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    place = (mix(sh ^ _SALT[0]) % np.uint64(REGISTERS)).astype(np.int64)
    np.minimum.at(least, row * REGISTERS + place, mix(sh ^ _SALT[1]) >> np.uint64(1))
    least = least.reshape(rows, REGISTERS)
    full = least != np.iinfo(np.uint64).max
    # A floating-point number is its exponent (the leading zeros) and its mantissa.
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    out = ((bits >> np.uint64(52 - MANTISSA)) - np.uint64(1023 << MANTISSA)).astype(np.uint16)
    out[~full] = 0
    r, c = np.nonzero(~full & full.any(axis=1)[:, None])
    at = c.copy()
    stride = (mix(np.arange(REGISTERS, dtype=np.uint64) ^ _SALT[2]) % np.uint64(REGISTERS - 1)).astype(np.int64) + 1
    while len(r):
        at = (at + stride[c]) % REGISTERS
        got = full[r, at]
        out[r[got], c[got]] = out[r[got], at[got]]
        r, c, at = r[~got], c[~got], at[~got]
    return out


def band_hashes(sketch: np.ndarray) -> np.ndarray:
    bands = sketch[:, :BANDS * ROWS].reshape(len(sketch), BANDS, ROWS).astype(np.uint64)
    h = np.zeros(bands.shape[:2], dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        h = mix(h * _SALT[3] + bands[:, :, k])
    return h.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, less what chance makes equal.

    Two smallest hashes of sets of n and m shingles fall into one cell of the register by chance with a
    probability of about 0.72 nm / (n + m)^2 / 2^MANTISSA: cells are on average 0.72 / 2^MANTISSA of their value wide.
    """
    equal = (a == b).mean(axis=1)
    chance = 0.72 * n * m / (n + m) ** 2 / 2**MANTISSA
    return (equal - chance) / (1 - chance)


def _words(part: pa.RecordBatch) -> Words:
    return Words([lower_ascii(t) if t else None for t in as_bytes(part.column("text"))])


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 1 << 20):
            rows = part.num_rows
            row, sh = shingle_hashes(_words(part), size)
            n = np.bincount(row, minlength=rows)
            sums = []
            for salt in _SALT[2:4]:
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sh ^ salt))))
                last = np.cumsum(n)
                sums.append((total[last] - total[last - n]).view(np.int64))
            sketch = registers(row, sh, rows)
            bands = band_hashes(sketch)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), *map(pa.array, sums),
                 pa.array([s.tobytes() for s in sketch[:, :ESTIMATED]], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))],
                ["id", "n", "k1", "k2", "sketch", "bands"],
            )

    return run


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    limit = PERCENT / 100
    limit -= DEVIATIONS * (limit * (1 - limit) / ESTIMATED) ** 0.5
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, ESTIMATED)
                for c in ("sketch_u", "sketch_v"))
        n, m = (batch.column(c).to_numpy() for c in ("n_u", "n_v"))
        ok = pa.array(estimate(a, b, n, m) >= limit)
        yield batch.select(["u", "v"]).filter(ok)


def shingles(text: str | None, size: int = SHINGLE) -> frozenset:
    words = lower_ascii(text.encode()).split() if text else []
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(size))))


def similar(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return 100 * both >= PERCENT * (len(a) + len(b) - both) and both > 0


def _similar(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, a = None, frozenset()
            keep = []
            for id, x, y in zip(*(batch.column(c).to_pylist() for c in ("u", "text_u", "text_v"))):
                if (id, x) != u:
                    u, a = (id, x), shingles(x, size)
                keep.append(similar(a, shingles(y, size)))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _side(table: DataFrame, c: str) -> DataFrame:
    """The table with ``id`` as ``c`` and its other columns marked likewise."""
    return table.select(*[F.col(x).alias(c if x == "id" else f"{x}_{c}") for x in table.columns])


def _texts(docs: DataFrame, ids: DataFrame, tables: Scratch) -> DataFrame:
    return tables.write(docs.join(small(tables.write(ids.distinct())), "id", "leftsemi"))


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, tables: Scratch) -> DataFrame:
    """Those of the pairs (u, v) whose sets of words are similar."""
    texts = _texts(docs, pairs.select(F.explode(F.array("u", "v")).alias("id")), tables)
    both = pairs.join(_side(texts, "u"), "u").join(_side(texts, "v"), "v")
    return tables.write(both.select("u", "v", "text_u", "text_v").mapInArrow(lean(_similar(size)), "u bigint, v bigint"))


def _star_links(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, tables: Scratch) -> DataFrame:
    sketches = reps.select("id", "n", "sketch")
    alike = pairs.join(_side(sketches, "u"), "u").join(_side(sketches, "v"), "v") \
        .where(F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * PERCENT)
    alike = tables.write(alike.select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v")
                         .mapInArrow(lean(_plausible), "u bigint, v bigint"))
    return _confirmed(alike, docs, size, tables)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 1 << 20):
            row, sh = shingle_hashes(_words(part), size)
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=part.num_rows))).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(sh.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("id"), sets], ["id", "shingles"])

    return run


def _keyed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets, owners and hashes of all shingles; a hash is another one in every group."""
    sets = table.column("shingles").combine_chunks()
    n = sets.value_lengths().to_numpy()
    group = mix(table.column("g").to_numpy().astype(np.int64).view(np.uint64))
    owner = np.repeat(np.arange(len(n)), n)
    return n, owner, sets.flatten().to_numpy().view(np.uint64) ^ group[owner]


def _block_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """Similar pairs of one from each side: for each on the left, the first of every other component."""
    u, v = [], []
    if left.num_rows and right.num_rows:
        n, _, a = _keyed(left)
        m, owner, b = _keyed(right)
        order = np.argsort(b, kind="stable")
        b, owner = b[order], owner[order]
        low, high = np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")
        ids, others = (t.column("id").to_numpy() for t in (left, right))
        own, theirs = (t.column("c").to_numpy() for t in (left, right))
        end = np.cumsum(n)
        for i in range(len(n)):
            lo, size = low[end[i] - n[i]:end[i]], (high - low)[end[i] - n[i]:end[i]]
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            both = np.bincount(owner[at], minlength=len(m))
            hit = np.flatnonzero((100 * both >= PERCENT * (n[i] + m - both)) & (both > 0) & (theirs != own[i]))
            if len(hit):
                hit = hit[np.unique(theirs[hit], return_index=True)[1]]
                u += [int(ids[i])] * len(hit)
                v += others[hit].tolist()
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _hidden_links(members: DataFrame, groups: DataFrame, docs: DataFrame, size: int, tables: Scratch) -> DataFrame:
    """Links between different components that share a bucket but were not compared yet."""
    of = groups.withColumnRenamed("node", "id").withColumnRenamed("component", "c")
    own = tables.write(members.join(of, "id", "left").withColumn("c", F.coalesce("c", "id")))
    mixed = tables.write(own.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high"))
                         .where("low < high").select("band"))
    first = groups.select(F.col("node").alias("pivot"), F.col("component").alias("g"))
    own = own.join(mixed, "band", "leftsemi").where("id <> pivot").join(first, "pivot", "left") \
        .withColumn("g", F.coalesce("g", "pivot"))
    right = tables.write(own.select("g", "id", "c", "n").distinct())
    left = right.where("c <> g")
    # Shares of the two sides of every group by their shingles; groups of one share go many to a block.
    sizes = tables.write(right.groupBy("g").agg(
        F.ceil(F.sum(F.when(F.col("c") != F.col("g"), F.col("n"))) / LEFT_SHINGLES).alias("lefts"),
        F.ceil(F.sum("n") / RIGHT_SHINGLES).alias("rights"), F.sum("n").alias("n"),
    ).where("lefts IS NOT NULL"))
    blocks = (sizes.where("lefts = 1 AND rights = 1").agg(F.sum("n")).first()[0] or 0) // RIGHT_SHINGLES + 1
    sets = tables.write(_texts(docs, right.join(sizes, "g", "leftsemi").select("id"), tables)
                        .mapInArrow(lean(_sets(size)), "id bigint, shingles array<bigint>"))

    def dealt(side: DataFrame, mine: str, other: str) -> DataFrame:
        share = F.pmod(F.xxhash64("id"), F.col(mine))
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias("other")
        split = side.select("g", "id", "c").join(sizes.drop("n"), "g") \
            .select("g", "id", "c", "lefts", "rights", share.alias("own"), every)
        pair = ("own", "other") if mine == "lefts" else ("other", "own")
        block = F.when((F.col("lefts") == 1) & (F.col("rights") == 1), F.pmod(F.xxhash64("g"), F.lit(blocks))) \
            .otherwise(F.xxhash64("g", *pair))
        full = split.select("g", "id", "c", block.alias("block")).join(sets, "id")
        return full.select(*[F.col(x).alias(x) for x in ("g", "id", "c", "block", "shingles")])

    found = dealt(left, "lefts", "rights").groupBy("block").cogroup(dealt(right, "rights", "lefts").groupBy("block")) \
        .applyInArrow(_block_links, "u bigint, v bigint")
    pairs = found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return _confirmed(tables.write(pairs), docs, size, tables)


def _shared_ids(whole: DataFrame, classes: DataFrame) -> DataFrame:
    """Links from ids with several sets to the classes of those sets."""
    sets = whole.select("id", "k1", "k2", "n").distinct()
    several = sets.groupBy("id").count().where("count > 1").select("id")
    return sets.join(several, "id", "leftsemi").join(classes, ["k1", "k2", "n"]) \
        .select(F.col("rep").alias("u"), F.col("id").alias("v")).where("u <> v")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id``, ``kept``. Written to the shared folder."""
    docs = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    with Scratch(docs.sparkSession) as tables:
        sets = tables.write(docs.mapInArrow(
            lean(_sketch(size)), "id bigint, n bigint, k1 bigint, k2 bigint, sketch binary, bands array<bigint>"
        ))
        whole = sets.where("n > 0 AND id IS NOT NULL")
        classes = tables.write(whole.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep")))
        reps = tables.write(whole.join(classes.withColumnRenamed("rep", "id"), ["k1", "k2", "n", "id"], "leftsemi")
                            .select("id", "n", "sketch", "bands"))
        banded = reps.select("id", "n", F.explode("bands").alias("band"))
        buckets = tables.write(banded.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("top"))
                               .where("pivot < top").select("band", "pivot"))
        members = tables.write(banded.join(buckets, "band"))
        stars = members.where("id <> pivot").select(F.col("pivot").alias("u"), F.col("id").alias("v")).distinct()
        links = tables.write(_star_links(stars, reps, docs, size, tables).union(_shared_ids(whole, classes)))
        groups = tables.write(components(links, tables))
        more = _hidden_links(members, groups, docs, size, tables)
        if not more.isEmpty():
            groups = tables.write(components(links.union(more), tables))
        of_class = tables.write(classes.join(groups, F.col("rep") == F.col("node"), "left")
                                .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id")))
        rows = sets.select("id", "n", "k1", "k2").join(of_class, ["k1", "k2", "n"], "left")
        return written(rows.select(
            "id", F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        ).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row of every group of near copies, with its own columns: the one with the smallest id.

    Where ids repeat or are missing, rows are numbered and written first: they are documents of their own, and
    exactly one stays. Missing ids come last; of equal ids any row stays, the same one in every task.
    """
    number = F.col(id).cast("bigint")
    if docs.groupBy(number.alias("id")).count().where("id IS NULL OR count > 1").isEmpty():
        gone = near_duplicates(docs, id, text, size).where("NOT kept").select(F.col("id").alias("gone"))
        return docs.join(small(written(gone)), number == F.col("gone"), "leftanti")
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))
    groups = near_duplicates(rows.select("row", F.col("doc")[text].alias("text")), "row", "text", size)
    own = rows.select("row", F.col("doc")[id].alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))["row"]
    several = groups.groupBy("component_id").count().where("count > 1").select("component_id")
    many = written(groups.join(several, "component_id", "leftsemi").select(F.col("id").alias("row"), "component_id"))
    kept = own.join(many, "row").groupBy("component_id").agg(first.alias("row")).select("row")
    gone = many.join(kept, "row", "leftanti").select("row")
    return rows.join(small(written(gone)), "row", "leftanti").select("doc.*")


def op5_hyperminhash(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")
