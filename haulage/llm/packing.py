"""Operator 7: packing token sequences by first-fit decreasing in randomised groups.

A document is its ids and an end id. Whole stretches of ``LENGTH`` ids become sequences of their own; what is
left of each document goes to a random group, and every group is packed on its own: pieces by falling
length, each into the first sequence with room, found in a tournament tree whose nodes hold the most
room below them. Groups hold at most about ``GROUP`` pieces whatever their documents' sizes, sources or
ids, so none is large; packing sees lengths only, never ids.

Defined results: a missing or empty text is its end id alone; rows are packed each, also if their ids repeat
or are missing; an empty table gives no pieces. The group of a row follows from a seed and the row's place in the
input, so a task that runs again gives the same. Added columns come beside the row in ``doc``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import documents, encoder, tokenizer_file
from .words import pieces
from .workers import give_back

LENGTH = 1024
END_ID = 0
GROUP = 8192
SEED = 7
CHUNK_BYTES = 1 << 20  # of text at a time: what encoding takes beside the remembered pieces


class Bins:
    """Bins of equal size in a tournament tree; ``place`` finds the first with room from the root down."""

    def __init__(self, most: int, size: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [size] * (2 * self.leaves)

    def place(self, length: int) -> int:
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        room[at] -= length
        bin = at - self.leaves
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return bin


def first_fit_decreasing(lengths: np.ndarray, size: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; equal lengths keep their order, bins are numbered without gaps."""
    bins, used = Bins(len(lengths), size), np.zeros(len(lengths), dtype=np.int64)
    bin, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bin[i] = b = bins.place(int(lengths[i]))
        offset[i] = used[b]
        used[b] += lengths[i]
    return bin, offset


def _cut(file: str, length: int, end: int):
    """Pieces of every document: stretches of ``length`` ids and the rest."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(file, spaces_kept=True)
        for part in pieces(batches, "text", CHUNK_BYTES):
            out: dict[str, list] = {c: [] for c in ("row", "start", "length", "ids_crc32", "doc_tokens")}
            for row, ids in enumerate(documents(known, part.column("text"), end)):
                for start in range(0, len(ids), length):
                    piece = ids[start:start + length]
                    for c, v in zip(out, (row, start, len(piece), zlib.crc32(piece), len(ids))):
                        out[c].append(v)
            doc = part.column("doc").take(pa.array(out.pop("row"), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [doc] + [pa.array(v, pa.int64()) for v in out.values()], ["doc", *out]
            )
            del out, doc
            give_back()

    return cut


def _pack(length: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        whole = lengths == length
        bin, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        bin[~whole], offset[~whole] = first_fit_decreasing(lengths[~whole], length)
        bin[whole] = int(bin.max(initial=-1)) + 1 + np.arange(whole.sum())
        # Numbers of a group's sequences fit in 32 bits, since a group is small.
        number = (np.int64(key[0].as_py()) << 32) + bin
        return table.drop_columns(["group"]).append_column("sequence_id", pa.array(number)) \
            .append_column("offset", pa.array(offset))

    return pack


def pack(docs: DataFrame, text: str = "text", file: str | None = None, length: int = LENGTH,
         end: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc`` (the row without its text), ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset``."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    cut = f"doc {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    parts = rows.mapInArrow(_cut(file or tokenizer_file("byte_bpe_50k.json"), length, end), cut)
    # A byte is at most one id, so no more pieces than this come out.
    most = docs.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)) / length).first()[0]
    groups = max(1, int(most) // group)
    return parts.withColumn("group", F.floor(F.rand(SEED) * groups).cast("bigint")) \
        .groupBy("group").applyInArrow(_pack(length), cut + ", sequence_id bigint, offset bigint")


def sequences(docs: DataFrame, placed: DataFrame, id: str = "doc_id", text: str = "text",
              file: str | None = None, length: int = LENGTH, end: int = END_ID, pad: int = 0) -> DataFrame:
    """``sequence_id`` and ``ids``: the sequences that ``placed`` (with the id column) lays out.

    Ids must be unique. A sequence is padded to ``length`` unless its own length is a power of two.
    """
    file = file or tokenizer_file("byte_bpe_50k.json")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(file, spaces_kept=True)
        for part in pieces(batches, "text"):
            ids = list(documents(known, part.column("text"), end))
            at = part.column("parts").to_pylist()
            rows = [(p["sequence_id"], p["offset"], ids[r][p["start"]:p["start"] + p["length"]].astype(np.int64))
                    for r, ps in enumerate(at) for p in ps]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["sequence_id", "offset", "ids"],
            )

    parts = placed.groupBy(id).agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("parts"))
    filled = docs.select(id, F.col(text).alias("text")).join(parts, id).select("text", "parts") \
        .mapInArrow(fill, "sequence_id bigint, offset bigint, ids array<bigint>")
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
    n = F.size("ids")
    padding = F.array_repeat(F.lit(pad).cast("bigint"), F.when(F.bit_count(n) == 1, 0).otherwise(length - n))
    return filled.groupBy("sequence_id").agg(ids.alias("ids")) \
        .select("sequence_id", F.concat("ids", padding).alias("ids"))


def op7_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs).select(F.col("doc.doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                             "sequence_id", "offset")
