"""Operator 1: shards by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table: an offset and a step from hashes of
its name. Shards take turns, each claiming the first slot of its order that is free, until the table is full. A row
goes to the shard in the slot that its key's hash names. All shards get within one slot of the same share,
and when a shard is added or removed, few slots change hands.

The table is filled once on the driver and broadcast: it has ``SLOTS`` rows whatever the data, at most
``MOST_SLOTS``. Placement reads the key column alone and moves nothing.

Defined results: a missing key is placed as the empty text; equal keys meet in one shard; an empty table gives an
empty one. Added columns come beside the row in ``doc``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 4099  # a prime, over a hundred times the number of shards
SHARDS = 32
MOST_SLOTS = 1 << 20
HEX = 15  # digits of a checksum that fit in a signed 64-bit number


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard of every slot."""
    if slots > MOST_SLOTS:
        raise ValueError(f"{slots} slots; tables of up to {MOST_SLOTS} are broadcast")
    if not shards or len(shards) > slots or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number, no smaller than the number of shards")
    offset = [_hash(f"{s}#offset") % slots for s in shards]
    step = [_hash(f"{s}#step") % (slots - 1) + 1 for s in shards]
    owner, left = [-1] * slots, slots
    at = list(offset)
    while True:
        for s in range(len(shards)):
            while owner[at[s]] >= 0:
                at[s] = (at[s] + step[s]) % slots
            owner[at[s]] = s
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HEX)
    return F.conv(digits, 16, 10).cast("bigint") % slots


def table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    owner = fill(shards, slots)
    rows = [(slot, s, shards[s]) for slot, s in enumerate(owner)]
    return spark.createDataFrame(rows, "slot bigint, shard int, shard_name string")


def place(docs: DataFrame, key: str = "doc_id", shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """Every row's ``doc``, ``slot``, ``shard`` and ``shard_name``."""
    names = shards or [f"shard-{i:04d}" for i in range(SHARDS)]
    rows = docs.select(F.struct("*").alias("doc"), slot_of(F.col(key), slots).alias("slot"))
    return rows.join(F.broadcast(table(docs.sparkSession, names, slots)), "slot") \
        .select("doc", "slot", "shard", "shard_name")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard. A shard that got many rows is written by several tasks."""
    placed.hint("rebalance", "shard_name").select("doc.*", F.col("shard_name").alias("shard")) \
        .write.partitionBy("shard").parquet(path)


def op1_sharding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs).select(F.col("doc.doc_id").alias("doc_id"), "slot", "shard", "shard_name")


ORACLE_SQL = f"""
WITH RECURSIVE shards AS (
    SELECT s, 'shard-' || lpad(CAST(s AS VARCHAR), 4, '0') AS name FROM range({SHARDS}) t(s)
), orders AS (
    SELECT list(CAST('0x' || substr(md5(name || '#offset'), 1, {HEX}) AS BIGINT) % {SLOTS} ORDER BY s) AS o,
           list(CAST('0x' || substr(md5(name || '#step'), 1, {HEX}) AS BIGINT) % {SLOTS - 1} + 1 ORDER BY s) AS d
    FROM shards
), turns AS (
    SELECT CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS slot,
           [CAST(-1 AS BIGINT) FOR x IN range({SLOTS})] AS owner FROM shards WHERE s = 0
    UNION ALL
    SELECT turn + 1, slot, owner[:slot] || [turn % {SHARDS}] || owner[slot + 2:]
    FROM (
        SELECT turn, owner, [(o[turn % {SHARDS} + 1] + j * d[turn % {SHARDS} + 1]) % {SLOTS} FOR j IN range({SLOTS})
               IF owner[(o[turn % {SHARDS} + 1] + j * d[turn % {SHARDS} + 1]) % {SLOTS} + 1] = -1][1] AS slot
        FROM turns, orders WHERE turn < {SLOTS}
    )
), filled AS (
    SELECT slot, CAST((turn - 1) % {SHARDS} AS INTEGER) AS shard FROM turns WHERE turn > 0
), placed AS (
    SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HEX}) AS BIGINT) % {SLOTS} AS slot
    FROM documents
)
SELECT doc_id, slot, shard, 'shard-' || lpad(CAST(shard AS VARCHAR), 4, '0') AS shard_name
FROM placed JOIN filled USING (slot)
"""
