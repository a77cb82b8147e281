from collections import Counter

import numpy as np
import pytest

from ledgerlight.llm import common, minhash as m
from llm_fixtures import awkward_docs, closure, docs_frame, empty_docs, similar, word_set


def test_components_are_the_closure(spark):
    rng = np.random.default_rng(1)
    ids = list(range(400))
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))] + [(300 + i, 301 + i) for i in range(60)] + [(5, 5), (7, 7)]
    links += [(399, i) for i in range(370, 399)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure(ids, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingle_sets_equal_plain_sets():
    texts = [None, "", " \n", "One", "one", "A b", "a\tB", "a b c d e", "é É x", "x\xa0y z", "a  b\r\nc", "aa b", "a ab"] + \
        [r[1] for r in awkward_docs()]
    for k in (1, 2, 5):
        fps, plain = m.shingle_sets(texts, k), [word_set(t, k) for t in texts]
        assert [len(x) for x in fps] == [len(x) for x in plain]
        for i in range(0, len(texts), 3):
            for j in range(len(texts)):
                assert len(np.intersect1d(fps[i], fps[j])) == len(plain[i] & plain[j])


def test_long_text_in_pieces(monkeypatch):
    text = awkward_docs()[-5][1]
    whole = m.shingle_sets([text], 2)[0]
    monkeypatch.setattr(m, "BLOCK", 1000)
    assert np.array_equal(m.shingle_sets(["x", text, None], 2)[1], whole)


def test_sketch_is_full_and_estimates_similarity():
    rng = np.random.default_rng(4)
    sets = []
    for n, share in ((3, 0.5), (40, 0.8), (400, 0.8), (5000, 0.3)):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n).astype(np.uint64))
        both = int(n * share)
        sets += [np.sort(np.r_[pool[:both], pool[both:n]]), np.sort(np.r_[pool[:both], pool[n:2 * n - both]])]
    s = m.sketches(sets, 2048)
    assert (s != m._NONE).all()
    for i in range(0, len(sets), 2):
        j = len(np.intersect1d(sets[i], sets[i + 1])) / len(np.union1d(sets[i], sets[i + 1]))
        assert abs((s[i] == s[i + 1]).mean() - j) < 0.06 + 0.5 / len(sets[i])
    assert np.array_equal(m.sketches(sets[2:3], 2048)[0], s[2])


@pytest.mark.parametrize("words", [2, 5])
def test_equals_brute_force(spark, words):
    rows = awkward_docs(7, 40)
    got = m.near_duplicates(docs_frame(spark, rows), words=words).collect()
    assert len(got) == len(rows)
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets[r[0]] = word_set(r[1], words)
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if similar(sets[a], sets[b])]
    want = closure(ids, links)
    want[None] = None
    sizes = Counter((r[0], len(word_set(r[1], words))) for r in rows)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == sizes
    for r in got:
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    kept = m.keep_one(docs_frame(spark, rows), words=words)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in rows if r[0] == want[r[0]])


def test_a_chain_and_a_star_of_different_texts(spark):
    """Links that no bucket leader sees: a chain of edits, and many variants of one text."""
    w = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(30):     # neighbours differ in a few words, the ends in nearly all
        rows.append((500 - k, " ".join(f"v{k}" if i < 3 * k else x for i, x in enumerate(w)), None, None, None))
    for k in range(60):
        rows.append((k, " ".join(f"u{k}" if i == k else f"q{i}" for i in range(100)), None, None, None))
    sets = {r[0]: word_set(r[1], 2) for r in rows}
    ids = sorted(sets)
    want = closure(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if similar(sets[a], sets[b])])
    got = {r["doc_id"]: r["component_id"] for r in m.near_duplicates(docs_frame(spark, rows, clash=False), words=2).collect()}
    assert got == want


def test_no_rows(spark):
    assert m.near_duplicates(empty_docs(spark)).count() == 0 and m.keep_one(empty_docs(spark)).count() == 0


def test_intersections_in_slices():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in (0, 1, 30, 300, 90, 90)]
    want = [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:3]]
    for width in (1, 7, 1 << 14):
        assert m.intersections(sets[:3], sets[3:], width).tolist() == want
    assert m.intersections([sets[0]], [sets[0]]).tolist() == [[0]]


def test_clump_over_several_blocks(spark):
    """Members that hang together by buckets only: links are found across blocks, within one label none is reported."""
    texts = [(i, " ".join(f"w{(i // 10) * 7 + j}" for j in range(60)) + f" z{i}", None, None, None) for i in range(60)]
    df = docs_frame(spark, texts, clash=False).selectExpr("doc_id as key", "text")
    mixed = spark.createDataFrame([(1, i, i) for i in range(60)], "band long, rep long, label long")
    links = [(r["a"], r["b"]) for r in m.clump_links(df, mixed, 2, 80, cell=7).collect()]
    sets = [word_set(r[1], 2) for r in texts]
    want = closure(range(60), [(a, b) for a in range(60) for b in range(a) if similar(sets[a], sets[b])])
    assert closure(range(60), links) == want and all(similar(sets[a], sets[b]) for a, b in links)
    one = mixed.withColumn("label", mixed["label"] * 0)
    assert m.clump_links(df, one, 2, 80, cell=7).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    text = lambda seed: " ".join(f"w{seed}x{i}" for i in range(60))
    rows = [(3, text(1) + " extra", "a", "s", 1), (5, text(1), "a", "s", 1), (5, text(2), "a", "s", 1), (7, text(2) + " more", "a", "s", 1)]
    got = m.near_duplicates(docs_frame(spark, rows), words=2).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in got) == Counter(
        [(3, 3, True, 60), (5, 3, False, 59), (5, 5, True, 59), (7, 5, False, 60)])


def test_own_ids_keep_the_order(spark):
    df = spark.createDataFrame([(5, 1), (5, 1), (5, -2), (-3, 7), (None, 9), (8, 0)], "k long, h long")
    same, none = common.own_ids(df.where("h <> -2"), "k", "h")
    assert none is None and same.columns == ["k", "h"]
    rows, ids = common.own_ids(df, "k", "h")
    back = {r["own"]: r["key"] for r in ids.collect()}
    got = [(r["k"], r["h"]) for r in rows.collect()]
    assert len(got) == 6 and sorted((back.get(k), h) for k, h in got if k is not None) == [(-3, 7), (5, -2), (5, 1), (5, 1), (8, 0)]
    assert [back[k] for k in sorted(back)] == [-3, 5, 5, 8]
