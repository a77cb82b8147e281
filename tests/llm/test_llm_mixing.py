import hashlib
from collections import Counter

import pytest

from ledgerlight.llm import mixing as m
from llm_fixtures import WORD, awkward_docs, docs_frame, empty_docs, prose


def fill(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Targets by sharing out the excess round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), share * sum(sizes.values())
    while True:
        rest = left - sum(repeats * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        target = {s: repeats * sizes[s] if s in full else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > repeats * sizes[s]}
        if not over:
            return target
        full |= over


def brute(rows):
    """Entries (id, source, text, alike) -> copies."""
    alike = Counter((r[0], r[3], r[1]) for r in rows)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = {}
    for (_, s, t), n in alike.items():
        sizes[s] = sizes.get(s, 0) + n * size(t)
    target = fill(sizes)
    place = lambda k: int(hashlib.md5(f"{'' if k is None else k}:{m.SEED}".encode()).hexdigest()[:13], 16)
    rank = {s: i for i, s in enumerate(sorted((s for s in sizes if s is not None), key=lambda s: s.encode()))}
    entries = []
    for s in sizes:
        cum = 0
        mine = sorted((e for e in alike if e[1] == s), key=lambda e: (place(e[0]), -1 if e[0] is None else e[0], alike[e] * size(e[2])))
        for e in mine:
            cum += alike[e] * size(e[2])
            for c in range(2):
                f = (c * sizes[s] + cum) / target[s] if target[s] > 0 else 0.0
                entries.append((f, rank.get(s, 99), cum, e))
    run, copies, budget = 0, Counter(), 1.5 * sum(sizes.values())
    for f, _, _, e in sorted(entries, key=lambda x: x[:3]):
        run += alike[e] * size(e[2])
        if run > budget:
            break
        copies[e] += 1
    return alike, sizes, target, copies, size


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = awkward_docs(seed, 200)
    alike, sizes, target, copies, size = brute(rows)
    got = m.mix(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["taken"] <= 2 * r["size"]
    want = Counter()
    for e, n in alike.items():
        want[(e[0], e[1], size(e[2]), copies[e] * size(e[2]))] += n
    assert Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got) == want
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    largest = max(size(r[1]) for r in rows)
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in sizes)


def test_take_repeats_whole_rows(spark):
    rows = awkward_docs(3, 80)
    alike, _, _, copies, size = brute(rows)
    df = docs_frame(spark, rows)
    out = m.take(df)
    assert out.columns == df.columns
    want = Counter({e: n * copies[e] for e, n in alike.items() if copies[e] and size(e[2])})
    assert Counter((r["doc_id"], r["source"], r["text"]) for r in out.collect()) == want


def test_slices_do_not_change_the_result(spark, monkeypatch):
    rows = [(i, prose(__import__("random").Random(i), 5 + i % 9), "x", "s1" if i % 3 else "s2", 1) for i in range(300)]
    df = docs_frame(spark, rows, clash=False)
    whole = sorted(map(tuple, m.mix(df).collect()))
    monkeypatch.setattr(m, "SLICE_ROWS", 16)
    assert sorted(map(tuple, m.mix(df).collect())) == whole


def test_empty_and_wordless(spark):
    assert m.mix(empty_docs(spark)).count() == 0 and m.take(empty_docs(spark)).count() == 0
    df = docs_frame(spark, [(1, "", "a", "s", 0), (2, None, "a", "s", 0), (3, " ", None, None, 0)])
    assert [(r["taken"], r["target"]) for r in m.mix(df).collect()] == [(0, 0.0)] * 3 and m.take(df).count() == 0
