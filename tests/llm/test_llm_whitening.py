import numpy as np
import pytest

from ledgerlight.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if e is None else float(e) for e in x], "c", "n", "x")
                                  for i, x in rows], SCHEMA)


def reference(rows):
    x = np.array([[int(np.floor(64 * float(np.float32(e)))) + 1_000_000 for e in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    c = np.array((x * n - s) / n, dtype=float)
    e, q = np.linalg.eigh(c.T @ c / n)
    deviation = ((x * n - s) ** 2).sum(axis=1)
    return n, deviation, c, e[::-1], q[:, ::-1], c.var(axis=0).sum()


def check(got, rows, components=32):
    n, deviation, c, e, q, total = reference(rows)
    k = min(components, len(e), int((e > 1e-12 * e[0]).sum()))
    assert len(got) == n * k
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = {}
    for row, (i, _) in enumerate(rows):
        for j in range(k):
            r = by_id[i][j + 1]
            want = c[row] @ q[:, j] / np.sqrt(e[j])
            if abs(want) > 1e-3:
                signs.setdefault(j, np.sign(want * r["whitened"]))
            assert r["n"] == n and r["deviation"] == deviation[row]
            assert abs(r["whitened"] * signs.get(j, 1) - want) < 1e-7, (i, j)
            assert abs(r["explained"] - e[j] / total) <= 1e-9 * r["explained"]
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("dim,n", [(64, 300), (20, 90), (80, 60)])
def test_equals_the_dense_eigenvectors(spark, dim, n):
    """The block inside the space, the block as the whole space, and fewer vectors than dimensions."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(n, dim)) * np.linspace(0.3, 3, dim) + rng.normal(size=dim)
    rows = list(enumerate(x.astype(np.float32)))
    check(w.whiten(frame(spark, rows).repartition(5)).collect(), rows)


def test_unusable_vectors_and_other_lengths(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(40, 5)).astype(np.float32))]
    bad = [(100, None), (101, []), (102, [1, None, 1, 1, 1]), (103, [float("nan")] * 5), (104, [float("inf"), 1, 1, 1, 1]),
           (105, [3e38, 1, 1, 1, 1]), (106, [1.0, 2.0]), (107, [0.5] * 7)]
    got = w.whiten(frame(spark, rows + bad), components=3).collect()
    check(got, rows, 3)
    assert w.whiten(frame(spark, bad[:6])).count() == 0
    assert w.whiten(frame(spark, rows).limit(0)).count() == 0
    assert w.whiten(frame(spark, [(1, [0.5, 0.5])] * 4)).count() == 0        # no variance


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(30, 4)).astype(np.float32))]
    rows += [rows[3], (None, rows[4][1])]
    got = w.whiten(frame(spark, rows)).collect()
    assert len(got) == 32 * 4 and sum(r["vec_id"] is None for r in got) == 4 and {r["n"] for r in got} == {32}


def test_large_entries_stay_exact(spark):
    rows = [(0, [2.0 ** 22, 1.0]), (1, [-(2.0 ** 22), 3.0]), (2, [0.25, 2.0])]
    check(w.whiten(frame(spark, rows)).collect(), rows)
    far = [(0, [2.0 ** 36, 1.0]), (1, [-(2.0 ** 36), 3.0])]
    assert {r["deviation"] for r in w.whiten(frame(spark, far)).collect()} == {None}


SPECTRA = {
    "flat": np.linspace(0.93, 1.07, 64),
    "decaying": 2.0 ** -np.arange(60.0),
    "low rank": np.concatenate([np.arange(1.0, 11.0), np.zeros(70)]),
    "clusters": np.repeat([5.0, 3.0, 1.0, 0.99], 25) + np.linspace(0, 1e-6, 100),     # one across the block's edge
}


@pytest.mark.parametrize("name", SPECTRA)
def test_filtered_iteration_on_known_spectra(name):
    e = np.sort(SPECTRA[name])[::-1]
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.normal(size=(len(e), len(e))))[0]
    v = (basis * e) @ basis.T
    got, q, worst = w.leading_pairs(lambda b: v @ b, len(e), 32)
    assert np.allclose(got, e[:32], rtol=1e-10, atol=1e-12 * e[0])
    assert np.abs(q.T @ q - np.eye(32)).max() < 1e-12
    assert np.linalg.norm(v @ q - q * got, axis=0).max() <= 1e-12 * e[0] and worst <= 1e-12 * e[0]
