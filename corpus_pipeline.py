"""A corpus through the training-data operators, stage by stage.

Defined results of all stages: a missing text has no words, which the rules reject; a later stage given one keeps
it. Missing hosts are a host of their own. Ids may repeat or be missing: rows count one by one, a missing id is larger
than any other. An empty table gives an empty one. Columns beside those of documents stay, whatever their names.

The stages set the session's ``BATCH`` to ``BATCH_BYTES``, where it has no value of its own, and leave it so: what they
return is computed later. Results do not hang on it.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import hostrules, hyperminhash, packing, superkmer, winnow
from haulage.llm.shared import Scratch, delete_unread, owned

# Of rows that go to a Python worker at a time. The worker and the JVM hold a batch whole, whatever the rows' texts.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

# What the stages have written on the way and their results read.
_left: list[Scratch] = []


def _work(stage):
    """The stage, whose own tables go when a later stage starts: its result is written by then.

    Should that be put off, and the next documents still read a table, it stays.
    """
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_unread(_left, docs)
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, BATCH_BYTES)
        with owned() as tables:
            result = stage(spark, docs, sf_dir)
        _left.extend(tables)
        return result

    return run


@_work
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules themselves and whose host passes."""
    return hostrules.keep_good(docs)


@_work
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, the one with the smallest id.

    Shingles are of two words, as in operator 5, whose groups these are: runs of five would miss copies in which one
    word in twenty differs, the very ones that a corpus should lose.
    """
    return hyperminhash.keep_first(docs)


@_work
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has."""
    return superkmer.remove_repeats(docs)


@_work
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return winnow.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_work
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

# Similarity, packing and tokens have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents, each written to the shared folder and read again.

    What a stage wrote goes when the next one has ended; the result reads the last copy, which stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        stored = Scratch(spark)
        docs = stored.write(stage(spark, docs, sf_dir))
        if before is not None:
            before.delete(spark)
        before = stored
    return STAGES[-1][1](spark, docs, sf_dir)
