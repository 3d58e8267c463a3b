"""Whitening against a dense eigendecomposition and exact whole numbers."""

import math

import numpy as np
import pytest

from quire.llm import whiten as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16):
    """(id, component) -> (n, deviation, whitened up to sign, explained)."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[float(n * c - t) / n for c, t in zip(x, s, strict=True)] for x in fit])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    out = []
    for i, x in good:
        d = [n * c - t for c, t in zip(x, s, strict=True)]
        out.append((i, n, sum(v * v for v in d), (np.array(d) / n) @ q / np.sqrt(e), e / np.trace(y.T @ y / n)))
    return out


def by_row(df):
    rows = {}
    for r in df.orderBy("component").collect():
        rows.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    return rows


def held(df, rows, k=16):
    want = brute(rows, k)
    got = by_row(df)
    assert df.count() == len(want) * k
    signs = None
    for i, n, dev, white, explained in want:
        found = [*{r["component"]: r for r in got[i, dev]}.values()]  # rows may repeat
        assert [r["component"] for r in found] == list(range(1, k + 1))
        assert all(r["n"] == n and 0 <= r["identity_error"] < 1e-9 for r in found)
        w = np.array([r["whitened"] for r in found])
        np.testing.assert_allclose([r["explained"] for r in found], explained, rtol=1e-9)
        np.testing.assert_allclose(np.abs(w), np.abs(white), rtol=1e-6, atol=1e-8)
        big = np.abs(white) > 1e-3
        now = np.where(big, np.sign(w * white), 0)
        signs = now if signs is None else np.where(signs == 0, now, signs)
        assert ((now == 0) | (now == signs)).all()  # one sign for all rows
    return got


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    df = wh.op11_whitening(spark, folder)
    assert df.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                              "identity_error"]
    held(df, rows)
    assert df.where("not certified").count() == 0


def awkward():
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.standard_normal(6)]) for i in range(40)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (7, rows[9][1])]
    return rows, [(200, None), (201, [1.0] * 5 + [None]), (202, [float("nan")] * 6),
                  (203, [float("inf")] + [0.0] * 5), (204, []), (205, [1.0, 2.0]), (206, [3e38] + [0.0] * 5)]


def test_unusable_rows_copies_and_missing_keys(spark):
    rows, bad = awkward()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], SCHEMA).repartition(3)
    out = wh.whiten(df.selectExpr("*", "1 AS n", "2 AS component", "3 AS k", "4 AS whitened"), 4)
    held(out, rows, 4)
    assert {r["vec_id"] for r in out.select("vec_id").distinct().collect()} == {i for i, _ in rows}
    assert wh.whiten(df).where("component = 1").count() == len(rows)  # six components at most
    assert wh.whiten(df).agg({"component": "max"}).first()[0] == 6


@pytest.mark.parametrize("vectors", [[], [None, [None]], [[]]])
def test_nothing_usable(spark, vectors):
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], SCHEMA)
    out = wh.whiten(df)
    assert out.count() == 0 and out.columns[0] == "vec_id"


def test_components_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0, 0.0], 0), (2, [2.0, 5.0, 0.0], 0), (3, [2.0, 5.0, 0.0], 0)], SCHEMA)
    rows = wh.whiten(df).orderBy("vec_id", "component").collect()
    assert [r["whitened"] and abs(round(r["whitened"], 9)) for r in rows] == [1, None, None] * 3
    assert rows[0]["explained"] == 1 and rows[0]["n"] == 2 and rows[0]["identity_error"] < 1e-12
    one = wh.whiten(df.limit(1)).collect()
    assert [r["whitened"] for r in one] == [None] * 3 and one[0]["deviation"] == 0


def test_deviation_beyond_a_long_is_null(spark):
    big = [(1, [2e8], 0), (2, [-2e8], 0), (3, [1.0], 0)]
    rows = wh.whiten(spark.createDataFrame(big, SCHEMA)).orderBy("vec_id").collect()
    assert rows[0]["deviation"] is None and rows[1]["deviation"] is None
    x = [math.floor(64 * v[0]) for _, v, _ in big]
    assert rows[2]["deviation"] == (3 * x[2] - sum(x)) ** 2


def spectra():
    r = np.random.default_rng(0)
    q = np.linalg.qr(r.standard_normal((30, 30)))[0]
    yield r.standard_normal((30, 30))
    yield np.diag([3.0] * 20 + [1.0] * 10)  # repeated eigenvalues
    yield q @ np.diag(10.0 ** -np.arange(30)) @ q.T
    yield q @ np.diag([1, 1 - 1e-10, 1 - 2e-10, *np.linspace(.5, .1, 27)]) @ q.T
    yield np.kron(np.eye(15), [[0, 1], [1, 0]])  # pivots of 0
    yield np.zeros((5, 5))
    yield np.array([[-2.0]])


@pytest.mark.parametrize("m", [*spectra()])
def test_spectrum(m):
    m = (m + m.T) / 2
    found = wh.leading_components(m, 12)
    want = np.linalg.eigvalsh(m)[::-1][:12]
    size = max(np.abs(want).max(), 1e-300)
    np.testing.assert_allclose([c.value for c in found], want, atol=1e-13 * size)
    v = np.array([c.vector for c in found])
    np.testing.assert_allclose(v @ v.T, np.eye(len(v)), atol=1e-13)
    assert np.abs(m @ v.T - v.T * [c.value for c in found]).max() <= 1e-13 * size


def test_counts_of_eigenvalues_below_a_shift():
    for m in spectra():
        m = (m + m.T) / 2
        e = np.linalg.eigvalsh(m)
        for s in np.linspace(e[0] - 1, e[-1] + 1, 23):
            if np.abs(e - s).min() > 1e-9:
                assert wh.inertia(m, s) == (e < s).sum()


def test_distinct_eigenvalues_are_certified():
    a = np.random.default_rng(4).standard_normal((200, 24))
    assert all(c.certified for c in wh.leading_components(a.T @ a / 200, 16))
