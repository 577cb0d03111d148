"""What tasks leave in a Python worker for those after them, and how much of the rows it holds at a time."""
from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulage.llm import packing, tokens, workers
from samples import SCHEMA, edited, prose

FILE = tokens.tokenizer_file("byte_bpe_50k.json")

# A worker's tasks one after the other, in a process of its own: MB before, at most and left.
TASKS = r"""
import random, re, sys, threading, time
import numpy as np, pyarrow as pa
from haulage.llm import packing, tokens

def held():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", text))) / 1024

def batch(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(8000)]
    texts = [" ".join(rng.choices(words, k=350)) for _ in range(1600)]
    doc = pa.StructArray.from_arrays([pa.array(range(1600))], ["doc_id"])
    return pa.RecordBatch.from_arrays([doc, pa.array(texts)], ["doc", "text"])

most, on = 0, True
def watch():
    global most
    while on:
        most = max(most, held())
        time.sleep(0.01)

batches = pa.BufferOutputStream()
first = batch(0)
with pa.ipc.new_file(batches, first.schema) as out:
    for seed in range(4):
        out.write_batch(batch(seed))
file = pa.ipc.open_file(batches.getvalue())
before = held()
threading.Thread(target=watch, daemon=True).start()
for _ in packing._cut(tokens.tokenizer_file("byte_bpe_50k.json"), 1024, 0)(file.get_batch(i) for i in range(4)):
    pass
on = False
print(before, most, held())
"""


def _batch(texts: list[str]) -> pa.RecordBatch:
    doc = pa.StructArray.from_arrays([pa.array(range(len(texts)))], ["doc_id"])
    return pa.RecordBatch.from_arrays([doc, pa.array(texts, pa.string())], ["doc", "text"])


def test_the_encoder_stays_for_its_own_tasks_and_goes_before_others():
    cut = packing._cut(FILE, 1024, 0)
    list(cut(iter([_batch([prose(1, 50)])])))
    mine = tokens.encoder(FILE, spaces_kept=True)
    list(cut(iter([_batch([prose(2, 50)])])))
    assert tokens.encoder(FILE, spaces_kept=True) is mine and mine.once
    at_work = []

    def other(batches):
        at_work.append(len(workers._kept))
        yield from batches

    rows = [_batch(["a"]), _batch(["b"])]
    assert list(workers.lean(other)(iter(rows))) == rows
    assert at_work == [0]


def test_a_lean_task_forgets_what_its_worker_kept(spark):
    def keep(batches):
        workers.kept(dict)
        yield from batches

    def count(batches):
        n = len(workers._kept)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n] * b.num_rows, pa.int64())], ["id"])

    rows = spark.range(0, 64, 1, 16)
    rows.mapInArrow(keep, "id bigint").collect()
    assert max(r.id for r in rows.mapInArrow(count, "id bigint").collect()) >= 1  # other tests may have left an encoder
    assert {r.id for r in rows.mapInArrow(workers.lean(count), "id bigint").collect()} == {0}


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
def test_encoding_holds_little_beside_what_it_remembers():
    run = subprocess.run([sys.executable, "-c", TASKS], capture_output=True, text=True, timeout=300,
                         cwd=Path(packing.__file__).parents[2])
    assert run.returncode == 0, run.stderr
    before, most, after = map(float, run.stdout.split())
    assert most - before < 70, run.stdout  # 100 in chunks of 4 MB of text, without giving back
    assert after - before < 10, run.stdout


@pytest.fixture
def unset(spark):
    spark.conf.unset(corpus_pipeline.BATCH)
    yield
    spark.conf.unset(corpus_pipeline.BATCH)


def _sizes(docs):
    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    return [r.n for r in docs.mapInArrow(size, "n bigint").collect()]


def test_batches_of_a_stage_are_bounded_in_bytes(spark, tmp_path, unset):
    long = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 10_000).alias("text"),
                                            F.lit("s").alias("source"))
    assert max(_sizes(long)) > 16 << 20
    corpus_pipeline.substring_dedup(spark, long, str(tmp_path))
    sizes = _sizes(long)
    assert len(sizes) > 3 and max(sizes) < 5 << 20 and sum(sizes) > 400 * 50_000


def test_a_session_keeps_its_own_size_of_batches(spark, frame, tmp_path, unset):
    spark.conf.set(corpus_pipeline.BATCH, "123k")
    corpus_pipeline.substring_dedup(spark, frame([(1, "a b", "en", "s", 3)], SCHEMA), str(tmp_path))
    assert spark.conf.get(corpus_pipeline.BATCH) == "123k"


@pytest.mark.parametrize("stage", ["near_dedup", "substring_dedup", "packed"])
def test_results_do_not_hang_on_the_size_of_batches(spark, frame, tmp_path, unset, stage):
    base, passage = prose(1, 150), prose(2, 40)
    texts = [base, base, edited(base, 1, 0.03), edited(base, 2, 0.3), None, ""]
    texts += [f"{prose(10 + i, 30)} {passage} {prose(50 + i, 30)}" for i in range(10)]
    docs = frame([(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    run = getattr(corpus_pipeline, stage)
    whole = sorted(map(repr, run(spark, docs, str(tmp_path)).collect()))
    spark.conf.set(corpus_pipeline.BATCH, "1")
    assert sorted(map(repr, run(spark, docs, str(tmp_path)).collect())) == whole


def test_values_of_a_slice_of_bytes():
    values = [b"", b"a", "é\n".encode(), b"long " * 9, b""]
    assert tokens._values(pa.array(values, pa.binary())) == values
    assert tokens._values(pa.array(values, pa.binary()).slice(1, 3)) == values[1:4]
    assert tokens._values(pa.array([], pa.binary())) == []
