import numpy as np
import pytest

from haulage.llm import whitening
from haulage.llm.whitening import fit, op11_whitening, orthogonalise, solve, usable, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n, width, seed=1):
    pick = np.random.default_rng(seed)
    mix = pick.normal(size=(width, width)) * np.geomspace(1, 0.01, width)
    return (pick.normal(size=(n, width)) @ mix * 0.3).astype(np.float32)


def plain(vecs):
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vecs]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    off = [[n * c - s for c, s in zip(row, sums)] for row in x]
    a = np.array(off, dtype=np.float64) / n
    e, w = np.linalg.eigh(a.T @ a / n)
    return [sum(c * c for c in row) for row in off], a, e[::-1], w[:, ::-1]


def check(out, model, vecs, ids):
    deviations, a, e, w = plain(vecs)
    got = {r.id: r for r in out.selectExpr("doc.vec_id AS id", "deviation", "whitened").collect()}
    assert [got[i].deviation for i in ids] == deviations
    white = np.array([got[i].whitened for i in ids])
    k = white.shape[1]
    expected = a @ w[:, :k] / np.sqrt(e[:k])
    expected *= np.sign((expected * white).sum(axis=0))
    assert np.allclose(white, expected, atol=1e-7)
    assert np.allclose(model.explained, e[:k] / e.sum(), rtol=1e-9)
    covariance = np.cov(white.T, bias=True).reshape(k, k)
    assert np.abs(covariance - np.eye(k)).max() < 1e-9 and model.identity_error < 1e-9


def test_against_eigenvectors(spark):
    vecs = vectors(300, 12)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vecs)], SCHEMA).repartition(5)
    out, model = whiten(df)
    assert len(model.explained) == 8 and model.n == 300
    check(out, model, vecs, range(300))


def test_rows_left_out_and_repeated(spark):
    vecs = vectors(60, 5)
    bad = [None, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [], [1.0] * 6]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vecs)] + [(100 + i, v, 0) for i, v in enumerate(bad)]
    rows += [(200 + i, vecs[7].tolist(), 0) for i in range(40)] + [(None, vecs[0].tolist(), 0)]
    out, model = whiten(spark.createDataFrame(rows, SCHEMA))
    assert model.n == 101
    check(out, model, np.concatenate([vecs, [vecs[7]] * 40, vecs[:1]]), [*range(60), *range(200, 240), None])


def test_directions_without_spread_are_no_components(spark):
    base = vectors(50, 3)
    vecs = np.column_stack([base, base[:, 0], np.full(50, 0.25, np.float32), base[:, 1]])
    out, model = whiten(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vecs)], SCHEMA))
    assert len(model.explained) == 3
    check(out, model, vecs, range(50))
    few, model = whiten(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors(4, 10))], SCHEMA))
    assert len(model.explained) == 3
    check(few, model, vectors(4, 10), range(4))


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0)] * 5])
def test_tables_without_spread(spark, rows):
    out, model = whiten(spark.createDataFrame(rows, SCHEMA))
    assert [r.whitened for r in out.collect()] == [[]] * len([r for r in rows if r[1]])
    assert model.explained == []


def test_large_entries_and_sums(spark):
    vecs = [[1e30, 1.0], [-1e30, 2.0], [3.0, float(2**33)], [5.0, 1.0]]
    out, model = whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vecs)], SCHEMA))
    assert [r.deviation for r in out.collect()] == [None] * 4 and model.identity_error < 1e-4
    vecs = [[1e5, 1.0], [-1e5, 2.0], [3.0, 7.0]]
    out, _ = whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vecs)], SCHEMA))
    assert sorted(r.deviation for r in out.collect()) == sorted(plain(vecs)[0])


def test_ill_conditioned_factors():
    pick = np.random.default_rng(3)
    q, _ = np.linalg.qr(pick.normal(size=(400, 6)))
    v, _ = np.linalg.qr(pick.normal(size=(6, 6)))
    sizes = np.array([1e6, 1e3, 1, 1e-1, 1e-3, 0])
    a = q * sizes @ v

    def gram_of(factors):
        y = a
        for r in factors:
            y = solve(y, r)
        return y.T @ y

    s = np.linalg.svd(orthogonalise(gram_of, 400, 6), compute_uv=False)
    assert np.allclose(s[:4], sizes[:4], rtol=1e-6) and np.isclose(s[4], sizes[4], rtol=1e-3) and s[5] < 1e-8


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors(30, 4))], SCHEMA)
    for name in ("doc", "v", "n", "width", "deviation", "whitened", "j", "component"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    out, _ = whiten(df)
    assert out.columns == ["doc", "deviation", "whitened"] and out.select("doc.*").columns == [
        c for c in df.columns if c != "embedding"]


def test_query(spark):
    import __spark_entry__ as entry

    out = op11_whitening(spark, entry.SMOKE_DIR)
    rows = out.collect()
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vecs = spark.read.parquet(f"{entry.SMOKE_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    deviations, a, e, w = plain([r.embedding for r in vecs])
    place = {r.vec_id: i for i, r in enumerate(vecs)}
    for k in range(8):
        own = sorted((place[r.vec_id], r.whitened, r.deviation, r.explained) for r in rows if r.component == k + 1)
        white, expected = np.array([o[1] for o in own]), a @ w[:, k] / np.sqrt(e[k])
        assert np.allclose(white * np.sign(white @ expected), expected, atol=1e-7)
        assert [o[2] for o in own] == deviations and abs(own[0][3] - e[k] / e.sum()) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
