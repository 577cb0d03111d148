import hashlib
import random
import time

import numpy as np
import pytest

import brute
from haulage.llm import periodic
from haulage.llm.periodic import candidates, op13_periodic, periodic_runs, planted, runs_of


def plain_runs(w):
    """Every maximal stretch with a period, if no smaller one is its period too."""
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and not any(
                    all(w[k] == w[k - d] for k in range(start + d, start + length)) for d in range(1, q)):
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = brute.words(text)
    if (put := planted(doc_id, len(w))) is not None:
        a, p = put
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def fast_runs(w):
    words = np.array(w, dtype=np.int64)
    place, lag = candidates(words, np.zeros(len(w), np.int64), len(w))
    return runs_of(w, place.tolist(), lag.tolist())


def test_random_texts_have_the_runs_of_the_plain_search():
    pick = random.Random(2)
    for _ in range(3000):
        w = [pick.randrange(pick.choice([1, 2, 3, 6])) for _ in range(pick.randrange(60))]
        if pick.random() < 0.7:  # repeat a stretch, with edits
            a, p = pick.randrange(len(w) + 1), pick.randrange(1, 15)
            w[a:a] = ([pick.randrange(3) for _ in range(p)] * 9)[:pick.randrange(2, 9 * p + 1)]
        assert fast_runs(w) == plain_runs(w), w


def test_runs_inside_runs():
    inner = [1] * 9 + [2]
    assert fast_runs(inner * 6) == plain_runs(inner * 6)
    nested = (inner * 5 + [3]) * 5 + [1] * 3
    assert fast_runs(nested) == plain_runs(nested)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    assert fast_runs(fib[-1] * 4) == plain_runs(fib[-1] * 4)


def test_texts_of_a_slice_do_not_match_each_other():
    rows = [[5, 6] * 3, [5, 6] * 3, [7] * 5, [7] * 5, [7] * 6]
    flat = np.array([x for r in rows for x in r])
    row = np.repeat(np.arange(5), [len(r) for r in rows])
    place, _ = candidates(flat, row, 6)
    runs = []
    for r, words in enumerate(rows):
        own = row[place] == r
        first = int(np.flatnonzero(row == r)[0])
        p, g = candidates(flat, row, 6)
        runs.append(runs_of(words, (p[own] - first).tolist(), g[own].tolist()))
    assert runs == [[], [], [], [], [(0, 6, 1)]]


@pytest.mark.parametrize("make", [lambda n: [0] * n, lambda n: [i % 2 for i in range(n)],
                                  lambda n: [0 if i % 1000 else i % 7 for i in range(n)],
                                  lambda n: [bin(i).count("1") % 2 for i in range(n)]])
def test_long_texts_take_time_in_proportion(make):
    started = time.process_time()
    words = make(200_000)
    runs = fast_runs(words)
    assert time.process_time() - started < 30
    assert fast_runs(words[:3000]) == plain_runs(words[:3000])
    assert all(length >= max(6, 4 * q) for _, length, q in runs)


def test_query_rows_against_the_plain_version(spark, frame, clashing, rows):
    docs = [r[:2] for r in rows if not r[1] or len(r[1]) < 20000] + [(None, "a b " * 9), (3, "x y z " * 5)]
    docs += [(100 + i, brute_text(i)) for i in range(120)]
    out = periodic_runs(clashing([(i, t, "", "", 0) for i, t in docs]).repartition(3), id="doc_id", plant=planted)
    names = ["start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(((r["doc"]["doc_id"], len(r["runs"]), *(r[n] for n in names)) for r in out.collect()), key=repr)
    assert got == sorted(((i, *plain_row(i, t)) for i, t in docs), key=repr)
    assert periodic_runs(frame([])).count() == 0


def brute_text(seed):
    pick = random.Random(seed)
    w = [f"w{pick.randrange(40)}" for _ in range(pick.randrange(150))]
    return " ".join(w + w[-pick.randrange(1, 9):] * pick.randrange(6))


def test_query(spark):
    import __spark_entry__ as entry

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").collect()}
    out = op13_periodic(spark, entry.SMOKE_DIR)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert set(got) == set(docs)
    for id, text in docs.items():
        if len(text or "") < 20000:
            assert got[id] == plain_row(id, text)
