"""Operator 8: token ids in files, by canonical length-limited Huffman coding.

``write_tokens`` encodes every text, adds the end id and writes a folder with two Parquet tables:

- ``codebook``: token and code length. Canonical codes follow from the lengths: shorter first, then by token.
- ``blocks``: part, block, start (tokens of the part before it), number of tokens, and the bytes of the block:
  four 32-bit numbers (documents, tokens, checkpoints, bytes of bits), then ids (64 bits) with a mark for
  missing ones (8 bits), tokens of each document, bit offsets of the checkpoints (32 bits each), bits. Numbers are
  little-endian, codes begin at the highest bit.

Parts follow each other in ascending order of document id (missing ids first, equal ids in any order), blocks in a part
likewise. A block can be read without any other; every ``EVERY`` tokens a checkpoint tells where
their codes begin, so a block is decoded from all its checkpoints at once, one table look-up for each
token. Code lengths are at most ``LONGEST``, by package-merge over the counts of all documents.

The texts are dealt by ranges of (id, random number), so that many rows with one id are no single part. Counts
are added up in the tasks first; the driver gets one number per token of the vocabulary and one per
part. Texts are encoded once, into a table of plain ids that is deleted afterwards.

Defined results: a missing or empty text is its end id alone; rows with equal or missing ids are kept
each; an empty table gives empty files, which read as an empty table; other columns are not read. Ids that are
no whole numbers end the query, and so do more than 2^``LONGEST`` different tokens: the vocabulary must be smaller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch
from .tokens import documents, encoder, tokenizer_file
from .words import pieces

END_ID = 2
LONGEST = 16
BLOCK = 1 << 18
EVERY = 256

PLAIN = "part int, block int, start bigint, n_tokens bigint, ids binary, missing binary, counts binary, tokens binary"
CODED = "part int, block int, start bigint, n_tokens bigint, data binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code with no length over ``longest``, by package-merge.

    ``counts`` are positive. Equal counts keep their order, so the result is the same for the same counts.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} tokens need codes longer than {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    merged, leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(longest - 1):
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        by = np.argsort(both, kind="stable")
        merged = both[by]
        leaf.append(by < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * (n - 1)
    for is_leaf in reversed(leaf):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes of some tokens, with the table that decodes ``longest`` bits at a time."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((tokens, lengths))
        tokens, lengths = tokens[order].astype(np.int64), lengths[order].astype(np.int64)
        self.longest = int(lengths.max(initial=1))
        # Each code begins where the one before ends, seen as stretches of all numbers of ``longest`` bits.
        stretch = 1 << (self.longest - lengths)
        first = np.cumsum(stretch) - stretch
        size = int(tokens.max(initial=0)) + 1
        self.code, self.length = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.code[tokens], self.length[tokens] = first >> (self.longest - lengths), lengths
        self.token_at = np.zeros(1 << self.longest, dtype=np.uint32)
        self.length_at = np.zeros(1 << self.longest, dtype=np.int64)
        filled = int(stretch.sum())
        self.token_at[:filled] = np.repeat(tokens, stretch)
        self.length_at[:filled] = np.repeat(lengths, stretch)

    def encode(self, tokens: np.ndarray, every: int = EVERY) -> tuple[np.ndarray, bytes]:
        """Bit offsets of every ``every``-th token, and the bits."""
        lengths = self.length[tokens]
        upto = np.cumsum(lengths)
        begin = upto - lengths
        n_bytes = (int(upto[-1]) + 7) // 8 if len(tokens) else 0
        # At most 7 + 16 bits from the byte in which a code begins: three bytes.
        bits = self.code[tokens] << (24 - lengths - (begin & 7))
        out = np.zeros(n_bytes + 3, dtype=np.int64)
        for k in range(3):
            part = np.bincount((begin >> 3) + k, weights=(bits >> (16 - 8 * k)) & 255, minlength=len(out))
            out += part.astype(np.int64)
        return begin[::every], out[:n_bytes].astype(np.uint8).tobytes()

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int, every: int = EVERY) -> np.ndarray:
        bits = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.int64)
        words = (bits[:-2] << 16) | (bits[1:-1] << 8) | bits[2:]
        out = np.zeros((len(checkpoints), every), dtype=np.uint32)
        at, mask, drop = checkpoints.astype(np.int64), (1 << self.longest) - 1, 24 - self.longest
        last = len(words) - 1
        for k in range(every if n >= every else n):
            seen = (words[np.minimum(at >> 3, last)] >> (drop - (at & 7))) & mask
            out[:, k] = self.token_at[seen]
            at += self.length_at[seen]
        return out.reshape(-1)[:n]


def pack_block(book: Codebook, ids: bytes, missing: bytes, counts: bytes, tokens: np.ndarray) -> bytes:
    marks, bits = book.encode(tokens)
    head = np.array([len(missing), len(tokens), len(marks), len(bits)], dtype="<u4")
    return b"".join([head.tobytes(), ids, missing, counts, marks.astype("<u4").tobytes(), bits])


def unpack_block(book: Codebook, data: bytes):
    """Ids (None if missing), tokens per document, tokens."""
    docs, n, marks, size = np.frombuffer(data, "<u4", 4).tolist()
    at = 16
    ids = np.frombuffer(data, "<i8", docs, at)
    at += 8 * docs
    missing = np.frombuffer(data, "u1", docs, at)
    at += docs
    counts = np.frombuffer(data, "<u4", docs, at)
    at += 4 * docs
    checkpoints = np.frombuffer(data, "<u4", marks, at)
    at += 4 * marks
    return pa.array(ids, mask=missing.astype(bool)), counts, book.decode(data[at:at + size], checkpoints, n)


def _plain(file: str, end: int, block: int):
    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(file, spaces_kept=False)
        held, size, number, start, part = [], 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.array([0 if i is None else i for i, _ in held], dtype="<i8").tobytes()
            missing = bytes(i is None for i, _ in held)
            counts = np.array([len(t) for _, t in held], dtype="<u4").tobytes()
            row = (part, number, start, size, ids, missing, counts, _narrow(np.concatenate([t for _, t in held])))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                ["part", "block", "start", "n_tokens", "ids", "missing", "counts", "tokens"],
            )

        for batch in pieces(batches, "text"):
            part = batch.column("part")[0].as_py()
            for id, tokens in zip(batch.column("id").to_pylist(), documents(known, batch.column("text"), end)):
                held.append((id, tokens))
                size += len(tokens)
                if size >= block:
                    yield close()
                    start, number, held, size = start + size, number + 1, [], 0
        if held:
            yield close()

    return plain


def _narrow(tokens: np.ndarray) -> bytes:
    """Two bytes a token where all fit, else four; the length tells which."""
    return tokens.astype("<u2" if tokens.max() < 1 << 16 else "<u4").tobytes()


def _tokens(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for data, n in zip(batch.column("tokens").to_pylist(), batch.column("n_tokens").to_pylist()):
            own = np.bincount(_tokens(data, n), minlength=len(total))
            own[:len(total)] += total
            total = own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])


def _encode(book: Codebook):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = pack_block(book, r["ids"], r["missing"], r["counts"], _tokens(r["tokens"], r["n_tokens"]))
                yield pa.RecordBatch.from_pylist(
                    [{k: r[k] for k in ("part", "block", "start", "n_tokens")} | {"data": data}],
                    pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()),
                               ("n_tokens", pa.int64()), ("data", pa.binary())]),
                )

    return encode


def write_tokens(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", file: str | None = None,
                 end: int = END_ID, block: int = BLOCK) -> None:
    """The token ids of all texts as files in ``path``, which must not exist."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"), F.rand(8).alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie") \
        .select(F.spark_partition_id().alias("part"), "id", "text")
    with Scratch(spark) as tables:
        plain = tables.write(dealt.mapInArrow(_plain(file or tokenizer_file("word_bpe_49k.json"), end, block), PLAIN))
        counts = plain.select("n_tokens", "tokens").mapInArrow(_count, "token bigint, n bigint") \
            .groupBy("token").agg(F.sum("n").alias("n")).orderBy("token").toArrow()
        tokens = counts.column("token").to_numpy()
        lengths = code_lengths(counts.column("n").to_numpy())
        spark.createDataFrame(pa.table({"token": tokens, "length": lengths})).coalesce(1) \
            .write.parquet(f"{path}/codebook")
        plain.mapInArrow(_encode(Codebook(tokens, lengths)), CODED) \
            .write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_codebook(spark: SparkSession, path: str) -> Codebook:
    codes = spark.read.parquet(f"{path}/codebook").toArrow()
    return Codebook(codes.column("token").to_numpy(), codes.column("length").to_numpy())


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document's id, ``start`` (tokens of all documents before it), ``n_tokens`` and ``ids``
    (32-bit numbers, little-endian)."""
    book = read_codebook(spark, path)
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    base, total = {}, 0
    for r in sorted(blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        base[r.part] = total
        total += r.n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, data in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "data"))):
                ids, counts, tokens = unpack_block(book, data)
                upto = np.cumsum(counts, dtype=np.int64)
                ends = pa.array(np.concatenate(([0], 4 * upto)).astype(np.int32))
                values = pa.Array.from_buffers(
                    pa.binary(), len(ids), [None, ends.buffers()[1], pa.py_buffer(tokens.astype("<u4").tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(base[part] + start + upto - counts), pa.array(counts, pa.int64()), values],
                    ["id", "start", "n_tokens", "ids"],
                )

    return blocks.select("part", "start", "data") \
        .mapInArrow(decode, "id bigint, start bigint, n_tokens bigint, ids binary")


def op8_huffman(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = Scratch(spark).folder
    write_tokens(docs, path)
    return read_tokens(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
