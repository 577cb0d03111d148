import random
import time

import numpy as np
import pyarrow as pa
import pytest

import brute
from samples import prose
from haulage.llm import superkmer
from haulage.llm.superkmer import remove_repeats, repeats


def plain(rows):
    return sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found(df, **options):
    out = repeats(df, **options).selectExpr("doc.doc_id", "doc.text", "n_words", "n_removed", "kept_text").collect()
    return sorted([tuple(r) for r in out], key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def expected(rows, window):
    docs = plain(rows)
    top = max((r[0] for r in docs if r[0] is not None), default=0) + 1
    kept = brute.kept_words([(top if i is None else i, t) for i, t in docs], window)
    return [(i, len(brute.words(t)), len(brute.words(t)) - len(k), " ".join(k)) for (i, t), k in zip(docs, kept)]


@pytest.mark.parametrize("window", [13, 5])
def test_edges_against_brute_force(frame, rows, window):
    assert [(r[0], *r[2:]) for r in found(frame(rows), window=window)] == expected(rows, window)


def test_many_repeats_over_many_partitions(frame, spark):
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice("abc") for _ in range(pick.randrange(60))), "en", "s", 0) for i in range(300)]
    df = frame(rows).repartition(7)
    assert [(r[0], *r[2:]) for r in found(df, window=6, buckets=8)] == expected(rows, 6)


def test_equal_and_missing_ids(frame):
    a, b = prose(1, 30), prose(2, 30)
    rows = [(5, a, "", "", 0), (5, a, "", "", 0), (5, b, "", "", 0), (None, b + " end", "", "", 0),
            (None, None, "", "", 0), (7, a + " " + b, "", "", 0)]
    assert [(r[0], *r[2:]) for r in found(frame(rows))] == expected(rows, 13)


def batch_of(texts, ids=None):
    zero = pa.array([0] * len(texts), pa.int64())
    check = zero if ids is None else pa.array([hash(t) for t in texts], pa.int64())
    ids = range(len(texts)) if ids is None else ids
    return pa.record_batch({"id": pa.array(ids, pa.int64()), "check1": check, "check2": zero, "text": pa.array(texts)})


def settled(dealt, window):
    out = set()
    for b in superkmer._settle(window)(iter(dealt)):
        for r in b.to_pylist():
            out |= {(r["id"], i) for i in range(r["first"], r["last"] + 1)}
    return out


def dealt_one_by_one(batch, buckets, hot, window):
    return pa.Table.from_batches(
        [b for i in range(len(batch)) for b in superkmer._deal(buckets, hot, window)(iter([batch.slice(i, 1)]))]
    ).sort_by([("bucket", "ascending"), ("least", "ascending")])


def test_buckets_in_parts_give_the_same(monkeypatch):
    batch = batch_of([prose(s, 60, 3) for s in range(40)])
    dealt = dealt_one_by_one(batch, 4, np.zeros(0, np.int64), 5)
    whole = settled(dealt.to_batches(max_chunksize=3), 5)
    for size in (500, 5000):
        monkeypatch.setattr(superkmer, "PART_BYTES", size)
        assert settled(dealt.to_batches(max_chunksize=3), 5) == whole and whole
    monkeypatch.setattr(superkmer, "HASHED_BYTES", 40)
    monkeypatch.setattr(superkmer, "AT_ONCE", 7)
    assert settled(dealt.to_batches(max_chunksize=3), 5) == whole


def test_other_contents_with_one_hash_are_told_apart():
    words = superkmer.Words([b"a b c", b"d e f", b"a b c"])
    at, same_hash = np.array([0, 3, 6]), np.zeros(3, np.uint64)
    later, leads, _ = superkmer._repeats(words.data, words.start[at], words.end[at + 2], same_hash, np.array([1, 2, 3]))
    assert later.tolist() == [False, False, True] and leads.tolist() == [True, True, False]


def test_hot_buckets_change_nothing(rows):
    batch = batch_of([r[1] for r in rows])

    def spans(hot):
        return settled(dealt_one_by_one(batch, 8, hot, 13).to_batches(), 13)

    assert spans(np.arange(superkmer.SLOTS)) == spans(np.zeros(0, np.int64)) != set()


def test_windows_of_a_final_id_are_held_once():
    texts = [f"{prose(1, 13)} x{i}" for i in range(200)]
    runs = superkmer.Runs(np.full(200, superkmer.LAST), np.column_stack([np.arange(200)] * 2),
                          np.zeros(200, np.int32), "".join(t + "\n" for t in texts).encode())
    spans, leaders = superkmer.settle(runs, 13, superkmer.LAST)
    assert spans.num_rows == 0
    # The common window once, and the 200 that end in a word of their own.
    held = leaders()
    assert sum(len(t.split()) - 12 for t in held.data.decode().splitlines()) == 201


def test_many_rows_with_one_id_are_one_slice_of_that_id():
    shared = prose(5, 20)
    batch = batch_of([f"{shared} {prose(100 + s, 20)}" for s in range(30)] + [f"a {shared}"], [None] * 30 + [4])
    dealt = pa.Table.from_batches(superkmer._deal(4, np.zeros(0, np.int64), 13)(iter([batch])))
    assert set(dealt["least"].to_pylist()) == {4, superkmer.LAST}
    found = settled(dealt.sort_by([("bucket", "ascending"), ("least", "ascending")]).to_batches(), 13)
    assert found == {(superkmer.LAST, i) for i in range(20)}


def test_rows_without_id_whose_32_bit_hashes_agree(spark, frame):
    tails = spark.range(400_000).selectExpr("concat('tail ', id) AS t", "hash(concat('tail ', id)) AS h")
    a, b = tails.groupBy("h").agg({"t": "collect_list"}).where("size(`collect_list(t)`) > 1").first()[1][:2]
    passage, other = prose(1, 30), prose(2, 30)
    rows = [(1, f"{passage} {a}", "", "", 0), (None, a, "", "", 0), (None, b, "", "", 0),
            (None, f"{passage} {b}", "", "", 0), (None, f"{other} {a}", "", "", 0)]
    assert [(r[0], *r[2:]) for r in found(frame(rows))] == expected(rows, 13)


def test_a_large_bucket_takes_time_in_proportion():
    pick = np.random.default_rng(5)

    def seconds(megabytes):
        blobs = []
        for i in range(megabytes):
            lines = [b" ".join(b"%x" % x for x in pick.integers(0, 1 << 20, 19)) for _ in range((1 << 20) // 110)]
            id = np.sort(pick.integers(0, 1 << 40, len(lines)))
            zero = np.zeros((len(lines), 2), np.int64)
            blobs.append(superkmer.Runs(id, zero, np.zeros(len(lines), np.int32), b"\n".join([*lines, b""])).pack())
        started = time.process_time()
        batches = (superkmer._rows([0], [blob], 0) for blob in blobs)
        assert sum(b.num_rows for b in superkmer._settle(13)(batches)) == 0
        return time.process_time() - started

    assert seconds(32) < 8 * max(seconds(8), 0.5)


def test_removal_keeps_columns_and_clean_texts(frame, clashing, rows):
    df = clashing(rows)
    out = remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] is None and texts[2] == "  \n\t " and texts[13] == "" and texts[12] == rows[12][1]
    assert repeats(frame([])).count() == 0
