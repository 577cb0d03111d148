"""Operator 3: benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer words is one window). Every
window of ``WINDOW - GRAM + 1`` consecutive runs of ``GRAM`` words keeps its smallest hash, in items and
documents alike, so a shared span of ``WINDOW`` words or more always has a fingerprint in common.
Items shorter than a window are outside that guarantee: their fingerprint is the whole item, and a document has
one at every word for each of their lengths.

Fingerprints of documents are joined with the benchmark's. In the documents that have some in common, these are
extended: the windows around them are looked up in the benchmark's, in a second join on 128 bits of
their words. What is joined first passes a table of ``FILTER_BITS`` bits, which has two set for every
fingerprint of the benchmark: it is of the same size for any benchmark, and what it lets through in vain the join
drops. Keys with over a ``HOT_PART``-th of the rows are joined in ``SALTS`` parts. Benchmark ids are lists per set of
items, put together once for each combination that documents have. Only tables measured to have at most
``BROADCAST_BYTES`` are broadcast.

Defined results: a missing or empty text has no words and no hits; items without words occur nowhere; an item
without an id is listed as "null"; repeated items count once by id; documents are judged each, also if their ids
repeat; an empty benchmark hits nothing. Added columns come beside the row in ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from .shared import Scratch, written
from .words import Words, as_bytes, gram_hashes, lower_alnum, mix, pieces, sliding_min, spans_covered, whole_runs
from .workers import lean

WINDOW = 10
GRAM = 4
FILTER_BITS = 26  # as a power of two: 8 MB
HOT_PART, SALTS = 1000, 64
BROADCAST_BYTES = 32 << 20
BATCH = 100_000


def fingerprints(words: Words, h: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Places and hashes of the runs of ``gram`` words that are smallest in a window (all, if equal)."""
    n, span = len(words) - gram + 1, window - gram + 1
    if len(words) < window:
        return np.zeros(0, dtype=np.int64), h[:0]
    grams = gram_hashes(h, gram)
    least = np.zeros(len(words) - window + 1, dtype=np.uint64)
    inside = whole_runs(words, window)
    least[inside] = sliding_min(grams, span)[inside]
    # A run is kept if it is as small as the smallest of any window around it; 0 stands for no window.
    padded = np.zeros(n + span - 1, dtype=np.uint64)
    padded[span - 1:span - 1 + len(least)] = least
    most = ~sliding_min(~padded, span)
    at = np.flatnonzero((most == grams) & (most > 0))
    return at, grams[at]


def short_prints(words: Words, h: np.ndarray, size: int):
    """Places and hashes of the runs of ``size`` words, other ones for every size."""
    at = whole_runs(words, size)
    return at, mix(gram_hashes(h, size)[at] + np.uint64(size)) if len(at) else h[:0]


def _words(column: pa.Array) -> Words:
    return Words([lower_alnum(t) if t else None for t in as_bytes(column)])


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the window and fingerprint, of items."""
    for part in pieces(batches, "text"):
        words = _words(part.column("text"))
        h, lengths = words.hashes(), np.diff(words.first)
        for size in [WINDOW, *np.unique(lengths[(lengths > 0) & (lengths < WINDOW)]).tolist()]:
            if size == WINDOW:
                keys = fingerprints(words, h)[1]
            else:
                at, keys = short_prints(words, h, size)
                keys = keys[lengths[words.row[at]] == size]
            keys = np.unique(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), size, np.int32)), pa.array(keys.view(np.int64))], ["size", "print"])


def _digests(words: Words, at: np.ndarray, size: np.ndarray) -> pa.Array:
    found = [xxhash.xxh3_128_digest(words.text(a, a + k - 1)) for a, k in zip(at.tolist(), size.tolist())]
    return pa.array(found, pa.binary())


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every window of items, and the item's id."""
    for part in pieces(batches, "text"):
        words = _words(part.column("text"))
        lengths = np.diff(words.first)
        short = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
        at = np.concatenate((whole_runs(words, WINDOW), words.first[short]))
        size = np.concatenate((np.full(len(at) - len(short), WINDOW), lengths[short]))
        for i in range(0, len(at), BATCH):
            some = at[i:i + BATCH]
            yield pa.RecordBatch.from_arrays(
                [_digests(words, some, size[i:i + BATCH]), part.column("id").take(pa.array(words.row[some]))], ["digest", "id"])


def _filter(prints: DataFrame) -> np.ndarray:
    """Bits of the fingerprints, two each, as 64-bit numbers."""
    low = (1 << FILTER_BITS) - 1
    slots = prints.select(F.explode(F.array(
        F.col("print").bitwiseAND(F.lit(low)), F.shiftrightunsigned("print", FILTER_BITS).bitwiseAND(F.lit(low)))).alias("slot"))
    bits = slots.groupBy(F.shiftright("slot", 6).alias("word")) \
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow()
    out = np.zeros(1 << max(0, FILTER_BITS - 6), dtype=np.uint64)
    out[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(bits: np.ndarray, keys: np.ndarray, width: int) -> np.ndarray:
    out = np.ones(len(keys), dtype=bool)
    for slot in (keys, keys >> np.uint64(width)):
        slot = slot & np.uint64((1 << width) - 1)
        out &= (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return out


def _document_prints(sizes: list[int], bits: np.ndarray, width: int):
    """Number of words, and the fingerprints that pass the filter, of documents."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            words = _words(part.column("text"))
            h = words.hashes()
            found = []
            for size in sizes:
                at, keys = fingerprints(words, h) if size == WINDOW else short_prints(words, h, size)
                near = _passes(bits, keys, width)
                found.append((at[near], np.full(int(near.sum()), size, np.int32), keys[near].view(np.int64)))
            at, size, keys = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
            order = np.argsort(at, kind="stable")
            at, size, keys = at[order], size[order].astype(np.int32), keys[order]
            row = words.row[at]
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            places = pa.StructArray.from_arrays(
                [pa.array((at - words.first[row]).astype(np.int32)), pa.array(size), pa.array(keys)], ["at", "size", "print"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("text"), pa.array(np.diff(words.first).astype(np.int64)),
                 pa.ListArray.from_arrays(ends, places)], ["doc", "text", "n_words", "prints"])

    return prints


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the windows around the places of documents that have a fingerprint in common."""
    back = np.arange(WINDOW - GRAM + 1)
    for part in pieces(batches, "text"):
        words = _words(part.column("text"))
        lengths, places = np.diff(words.first), part.column("places")
        for row, id in enumerate(part.column("row").to_pylist()):
            at = places[row].values.field("at").to_numpy().astype(np.int64)
            size = places[row].values.field("size").to_numpy().astype(np.int64)
            full = size == WINDOW
            around = np.unique((at[full][:, None] - back).ravel())
            around = around[(around >= 0) & (around + WINDOW <= lengths[row])]
            at = np.concatenate((around, at[~full]))
            size = np.concatenate((np.full(len(around), WINDOW), size[~full]))
            for i in range(0, len(at), BATCH):
                a, k = at[i:i + BATCH], size[i:i + BATCH]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id] * len(a), pa.int64()), pa.array(a.astype(np.int32)), pa.array(k.astype(np.int32)),
                     _digests(words, a + words.first[row], k)], ["row", "at", "size", "digest"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hit words and their spans, from the places and sizes of a document's windows."""
    for batch in batches:
        spans, n_hit = [], []
        for places in batch.column("places"):
            at, size = (places.values.field(x).to_numpy().astype(np.int64) for x in ("at", "size"))
            covered = np.zeros(int((at + size).max()), dtype=bool)
            for k in np.unique(size).tolist():
                covered |= spans_covered(at[size == k], k, len(covered))
            edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
            spans.append([{"first": a, "last": b - 1} for a, b in edge.reshape(-1, 2).tolist()])
            n_hit.append(int(covered.sum()))
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(n_hit, pa.int64()), pa.array(spans, kind), batch.column("key")],
            ["row", "n_hit", "spans", "key"])


def _light(table: DataFrame, size: Column) -> bool:
    """Whether the sizes of a written table's rows come to at most ``BROADCAST_BYTES``."""
    return (table.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= BROADCAST_BYTES


def _joined(rows: DataFrame, table: DataFrame, key: str, size: Column) -> DataFrame:
    """``rows``, which have a ``row``, with the one row of ``table`` that has their key. Both are written tables.

    A table that is not light is shuffled, and rows with a frequent key are dealt to ``SALTS`` parts; fewer
    than ``HOT_PART`` keys can be that frequent.
    """
    if _light(table, size):
        return rows.join(F.broadcast(table), key)
    least = rows.count() // HOT_PART
    hot = rows.groupBy(key).count().where(F.col("count") > least).select(key, F.lit(True).alias("hot"))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), key, "left")

    salted = marked(rows).withColumn("salt", F.when(F.col("hot"), F.pmod("row", F.lit(SALTS))).otherwise(0).cast("int"))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = marked(table).withColumn("salt", F.explode(parts))
    return salted.drop("hot").join(copies.drop("hot"), [key, "salt"]).drop("salt")


def _listed() -> Column:
    return F.octet_length(F.array_join("items", ",")) + 32


def _identity(*columns: str) -> Column:
    """128 bits of some columns."""
    return F.concat_ws("-", F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))


def _hits(seen: DataFrame, prints: DataFrame, items: DataFrame, tables: Scratch) -> DataFrame:
    """``row``, ``n_hit``, ``spans`` and ``items`` of the documents that hold a window."""
    shared = tables.write(seen.where(F.size("prints") > 0).select("row", F.inline("prints")))
    places = tables.write(_joined(shared, tables.write(prints.select("print").distinct()), "print", F.lit(16))
                          .groupBy("row").agg(F.collect_list(F.struct("at", "size")).alias("places")))
    beside = F.broadcast(places) if _light(places, 8 * F.size("places") + 16) else places
    near = seen.select("row", "text").join(beside, "row")
    around = tables.write(near.mapInArrow(lean(_extended), "row bigint, at int, size int, digest binary"))

    named = items.mapInArrow(lean(_item_windows), "digest binary, id string") \
        .groupBy("digest").agg(F.sort_array(F.collect_set("id")).alias("items"))
    named = tables.write(named.withColumn("set", _identity("items")))
    sets = tables.write(named.groupBy("set").agg(F.first("items").alias("items")))
    found = _joined(around, named.select("digest", "set"), "digest", F.octet_length("set") + 32).groupBy("row").agg(
        F.collect_list(F.struct("at", "size")).alias("places"), F.sort_array(F.collect_set("set")).alias("sets"))
    found = tables.write(found.withColumn("key", _identity("sets")))
    # Documents with the same sets have the same items.
    keys = found.groupBy("key").agg(F.first("sets").alias("sets")).select("key", F.explode("sets").alias("set"))
    listed = keys.join(sets, "set").select("key", F.explode("items").alias("item")) \
        .groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    spans = tables.write(found.select("row", "places", "key").mapInArrow(
        lean(_spans), "row bigint, n_hit bigint, spans array<struct<first:int,last:int>>, key string"))
    return _joined(spans, tables.write(listed), "key", _listed()).drop("key")


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Every row's ``doc``, ``text``, ``n_words``, ``n_hit``, ``items`` (ids, sorted) and hit word ``spans``."""
    rest = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text}
    with Scratch(docs.sparkSession) as tables:
        items = tables.write(benchmark.select(
            F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("text"),
        ).where(F.octet_length("text") > 0).distinct())
        prints = tables.write(items.mapInArrow(lean(_item_prints), "size int, print bigint").distinct())
        sizes = sorted(r[0] for r in prints.select("size").distinct().collect())
        rows = docs.select(F.struct(F.lit(0).alias("c"), *(docs[f"`{c.replace('`', '``')}`"].alias(n) for c, n in rest.items()))
                           .alias("doc"), F.col(text).alias("text"))
        more = T.StructType.fromDDL("n_words bigint, prints array<struct<at:int,size:int,print:bigint>>")
        schema = T.StructType(rows.schema.fields + more.fields)
        seen = written(rows.mapInArrow(lean(_document_prints(sizes, _filter(prints), FILTER_BITS)), schema)
                       .withColumn("row", F.monotonically_increasing_id()))
        hits = written(_hits(seen, prints, items, tables))
    beside = F.broadcast(hits) if _light(hits, 8 * F.size("spans") + _listed()) else hits
    whole = F.struct(*((F.col("text") if c == text else F.col("doc")[rest[c]]).alias(c) for c in docs.columns))
    none = F.lit(0).cast("bigint")
    return seen.join(beside, "row", "left").select(
        whole.alias("doc"), "text", "n_words", F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns."""
    return contamination(docs, benchmark).where("n_hit = 0").select("doc.*")


def op3_winnow(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH split AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words
    FROM documents
), items AS (
    SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS w
    FROM (SELECT item_id, words, least(10, len(words)) AS k,
                 unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)
), doc_windows AS (
    SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS w
    FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
          FROM split, (SELECT DISTINCT k FROM item_windows) WHERE len(words) >= k)
), hits AS (
    SELECT doc_id, k, i, item_id FROM doc_windows JOIN item_windows USING (k, w)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM split s LEFT JOIN covered c USING (doc_id) LEFT JOIN named i USING (doc_id)
"""
