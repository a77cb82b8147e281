import numpy as np

from ledgerlight.llm import vector_dedup as v
from llm_fixtures import closure

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, raw string, grp int"


def _rows(n=150, dim=16):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=dim), int(i % 3)) for i in range(n)]
    for g in range(4):      # near copies, in both labels of a group
        c = rng.normal(size=dim)
        rows += [(1000 + 100 * g + k, c + rng.normal(size=dim) * 0.03, g % 2 + (k % 10 == 0)) for k in range(40)]
    c = rng.normal(size=dim)
    rows += [(2000 + k, c * (1 + k % 3), 1) for k in range(60)]      # copies and multiples
    rows = [(i, [float(np.float32(e)) for e in x], y) for i, x, y in rows]
    rows += [(3000, None, 1), (3001, [0.0] * dim, 1), (3002, [float("nan")] * dim, 1), (3003, [None, *[1.0] * (dim - 1)], 1),
             (3004, rows[-1][1], None), (None, rows[-1][1], 1), (3005, [], 1), (3006, [1.0, 2.0], 1), (3007, [2.0, 4.0], 1),
             (3008, [float("inf")] * dim, 1), (3009, [-0.0, 3e38] + [0.0] * (dim - 2), 2), (3010, [0.0, 1e-30] + [0.0] * (dim - 2), 2)]
    rows += [rows[4], rows[4]]
    return [(*r, "x", "y", 1) for r in rows]


def brute(rows):
    ok = {}
    for i, (k, x, y, *_) in enumerate(rows):
        if k is not None and y is not None and x and None not in x and np.isfinite(x).all() and any(x):
            ok[i] = np.array(x) / np.abs(x).max()
    pairs = [(i, j) for i in ok for j in ok if i < j and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j])
             and ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= 0.98]
    n = [0] * len(rows)
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    ids = {r[0] for r in rows if r[0] is not None}
    comp = closure(ids, [(rows[i][0], rows[j][0]) for i, j in pairs])
    return sorted((repr(r[0]), n[i], repr(comp.get(r[0]))) for i, r in enumerate(rows))


def test_equals_brute_force(spark):
    rows = _rows()
    got = v.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"])) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_many_partitions_and_small_blocks(spark):
    """Windows across partition ends, and components over several blocks."""
    rows = _rows(60)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        got = v.near_vectors(df, window=4, passes=24).collect()
        assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"])) for r in got) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    members = spark.createDataFrame([("c", i, 1, np.array([1.0, i / 1000]).tobytes()) for i in range(100)],
                                    "component string, rep long, n long, raw binary")
    assert {r["n"] for r in v.link_counts(members, cell=7).collect()} == {100}


def test_no_rows(spark):
    assert v.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_that_no_pass_finds(spark):
    """Vectors that share a direction share their signs: the passes alone miss most of the planted pairs."""
    rng = np.random.default_rng(8)
    x = np.ones(32) + rng.normal(size=(1200, 32)) * 0.3
    near = x[:100] + rng.normal(size=(100, 32)) * 0.05
    rows = [(i, [float(np.float32(e)) for e in v], 1, "x", "y", 1) for i, v in enumerate([*x, *near])]
    df = spark.createDataFrame(rows, SCHEMA)
    for cell in (None, 500):        # one round, and several pieces of the label
        got = v.near_vectors(df, passes=2, window=2, cell=cell).collect()
        assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"])) for r in got) == brute(rows)
        assert sum(not r["kept"] for r in got) >= 100


def test_vectors_that_share_an_id_are_apart(spark):
    rows = [(5, [1.0, 0.0, 0.0], 1), (5, [0.0, 1.0, 0.0], 1), (3, [1.0, 0.01, 0.0], 1), (5, None, 1), (None, [0.0, 1.0, 0.0], 1)]
    got = v.near_vectors(spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(3, 1, 3, True), (5, 1, 3, False), (5, 0, 5, True), (5, 0, 5, True), (None, 0, None, True)], key=repr)
