"""Whitening by spectrum slicing against numpy's eigenvalues and plain loops."""

import numpy as np
import pytest

from statmart.llm import whitening as wh


def plain(vectors, k=8):
    """Integer vectors, deviations, eigenvalues, whitened coordinates and explained shares."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    d = x - s / n
    values, vecs = np.linalg.eigh(d.T @ d / n)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    return dev, values, d @ vecs / np.sqrt(values), values / np.trace(d.T @ d / n)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, component int, white string").repartition(4)


def check(out, rows, k):
    dev, values, white, share = plain([v for _, v in rows], k)
    got = {}
    for r in out:
        got.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(got) == list(range(1, k + 1))
    for c in got:
        mine = np.array([got[c][i]["whitened"] for i, _ in rows])
        sign = np.sign(mine @ white[:, c - 1])
        assert np.abs(sign * mine - white[:, c - 1]).max() < 1e-6
        for (i, _), w in zip(rows, dev):
            r = got[c][i]
            assert r["n"] == len(rows) and r["deviation"] == w and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(share[c - 1], rel=1e-9)
            assert r["distance"] == pytest.approx(w / len(rows) ** 2, rel=1e-9)


def test_counts_match_eigenvalues():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.normal(size=(size, size))
            a = a + a.T
            if size > 2:
                a[0, 0] = a[1, 1] = 0
            values = np.linalg.eigvalsh(a)
            for shift in rng.normal(size=4) * 3:
                assert wh.positive_pivots(a - shift * np.eye(size)) == (values > shift).sum()
    assert wh.positive_pivots(np.zeros((3, 3))) == 0
    assert wh.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


@pytest.mark.parametrize("values", [[9, 5, 3, 2, 1, .5, .2, .1, .05], [7, 7, 7, 2, 2, 1], [1e9, 1, 1e-3, 1e-6],
                                    [4, 4 - 1e-9, 4 - 2e-9, 1], [5, 3, 0, 0], [2] * 12])
def test_components_of_known_spectra(values):
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * np.array(values, dtype=float)) @ q.T
    a = (a + a.T) / 2
    found, vectors = wh.leading_components(a, 8)
    want = sorted(values, reverse=True)[:8]
    want = [w for w in want if w > 1e-13 * want[0]]
    assert found == pytest.approx(want, rel=1e-7, abs=1e-12 * want[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(want))).max() < 1e-12
    assert np.abs(vectors @ a - found[:, None] * vectors).max() < 1e-12 * want[0]


def test_sums_are_exact():
    rng = np.random.default_rng(3)
    for size in (10, 2 ** 20, 2 ** 30, 2 ** 45):
        y = rng.integers(-size, size, (300, 4))
        whole = wh.ProductSum(4)
        for at in range(0, 300, 70):
            whole.add(y[at:at + 70])
        assert (whole.total() == y.astype(object).T @ y.astype(object)).all()
        n, rest = 2 ** 20 + 7, np.array([5, -3, 2 ** 19, 0], dtype=object)
        want = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, rest)) for r in y]
        assert wh.deviations(y, n, rest) == [w if w < 2 ** 63 else None for w in want]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitened_rows(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 12)) * np.linspace(3, .5, 12)
    x[100:240] = x[100]  # a third of all rows are one vector
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    check(wh.whiten(frame(spark, rows, kind)).collect(), rows, 8)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 0.5]), (2, [3.0, -1.0, 0.25]), (3, [0.0, 0.0, 0.0]), (4, [2.5, 4.0, 9.0]), (5, [-1.0, 1.0, 7.0])]
    bad = [(10, None), (11, []), (12, [nan, 1.0, 1.0]), (13, [inf, 1.0, 1.0]), (14, [-inf, 1.0, 1.0]), (15, [1.0, None, 1.0]),
           (16, [1.0, 2.0]), (17, [1e300, 1.0, 1.0])]
    out = wh.whiten(frame(spark, good + bad, "double")).collect()
    check(out, good, 3)
    twice = wh.whiten(frame(spark, good + [(5, good[4][1]), (None, [1.0, 1.0, 1.0])], "double")).collect()
    assert len(twice) == 7 * 3 and sum(r["vec_id"] is None for r in twice) == 3 and {r["n"] for r in twice} == {7}
    far = [(1, [2.0 ** 50]), (2, [-2.0 ** 50]), (3, [0.0])]
    out = wh.whiten(frame(spark, far, "double")).collect()
    assert len(out) == 3 and {r["deviation"] for r in out} == {None, 0}


def test_nothing_to_divide_by(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        out = wh.whiten(frame(spark, rows))
        assert out.count() == 0 and out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                        "identity_error"]
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]  # one direction only
    assert {r["component"] for r in wh.whiten(frame(spark, flat)).collect()} == {1}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(wh.op12_spectrum_whitening(spark, folder).collect(), rows, 8)
