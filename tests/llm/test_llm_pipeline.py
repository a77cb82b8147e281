"""The whole pipeline against plain Python on a small corpus."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ledgerlight.llm import packing
from llm_fixtures import awkward_docs, closure, docs_frame, empty_docs, prose, similar, text_hash, word_set
from test_llm_lines import brute as line_brute
from test_llm_mixing import brute as mix_brute
from test_llm_quality import verdicts


def _rows():
    rng = random.Random(12)
    rows = [r for r in awkward_docs(12, 30) if r[0] not in (205, 206)]
    rows = [(a, t and t + "\n" + prose(rng, 60), lang, s, n) for a, t, lang, s, n in rows]
    lines = [prose(rng, 20) for _ in range(5)]
    for k in range(40):
        rows.append((400 + k, "\n".join([prose(rng, 40), rng.choice(lines), prose(rng, 30)]), "aa", f"s{k % 4}", None))
    base = prose(rng, 200)
    for k in range(6):      # near copies on one line each, all different
        w = base.split(" ")
        w[30 * k] = "edited"
        rows.append((600 + k, "\n".join([" ".join(w), f"tail {prose(rng, 3)}"]), "aa", "s1", 1))
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = _rows()
    # 1: quality
    bad = verdicts([(r[1], r[3]) for r in rows])
    rows1 = [r for r, (b, host) in zip(rows, bad) if not b and not host]
    # 2: lines
    rows2 = [(r[0], t, r[2], r[3], r[4]) for r, t in zip(rows1, line_brute(rows1))]
    # 3: near duplicates
    own = lambda r: (r[0], text_hash(r[1]))
    sets = {own(r): word_set(r[1], 5) for r in rows2 if r[0] is not None}
    ids = sorted(sets)
    comp = closure(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if similar(sets[a], sets[b])])
    rows3 = [r for r in rows2 if r[0] is None or comp[own(r)] == own(r)]
    # 4: mix
    alike, _, _, copies, size = mix_brute(rows3)
    rows4 = Counter({(e[0], e[2]): 0 for e in alike})
    for e, n in alike.items():
        if size(e[2]):
            rows4[(e[0], e[2])] += n * copies[e]
    rows4 = +rows4
    # 5: pieces
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for (k, text), n in rows4.items():
        total = len(t.encode(text, add_special_tokens=False).ids) + 1
        for i, (s, length) in enumerate(packing.cut(total)):
            pieces[(k, i, s, length)] += n

    docs = docs_frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stage, seen = docs, []
    for name, f in cp.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns
        stage.write.parquet(f"{tmp_path}/{name}")
        stage = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(Counter((r["doc_id"], r["text"]) for r in stage.collect()))
    plain = lambda rs: Counter((r[0], r[1]) for r in rs)
    assert seen[0] == plain(rows1)
    assert seen[1] == plain(rows2)
    assert seen[2] == plain(rows3)
    assert seen[3] == rows4
    got = cp.run(spark, str(tmp_path)).toPandas()
    assert Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length) for r in got.itertuples()) == pieces
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.cumsum(g["length"]) - g["length"]).all() and g["length"].sum() <= 1024


def test_no_rows(spark, tmp_path):
    empty_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES]


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Extra columns under the names that the stages use inside, and one with a dot, come back as they went in."""
    names = ["__m", "__bad_host", "__n", "__doc", "__hash", "__dropped", "__count", "__key", "__source", "__copy", "__copies", "rest",
             "n_dropped", "c0", "a.b", "tick`ed", "own", "content", "key", "id", "box"]
    rows = [r for r in _rows() if r[0] is not None]
    stage = docs_frame(spark, rows, clash=False).selectExpr("*", *(f"concat('{i}:', doc_id) as `{n.replace('`', '``')}`" for i, n in enumerate(names)))
    for name, f in cp.STAGES[:-1]:
        out = f(spark, stage, str(tmp_path))
        assert out.columns == stage.columns
        out.write.parquet(f"{tmp_path}/{name}")
        stage = spark.read.parquet(f"{tmp_path}/{name}")
        got = stage.collect()
        assert len(got) > 20
        for r in got:
            assert [r[n] for n in names] == [f"{i}:{r['doc_id']}" for i in range(len(names))], name


def test_texts_that_share_an_id_are_judged_apart(spark, tmp_path):
    """An id with two texts: nothing near the second one, so it stays; of near ones one stays, and of a line one."""
    rng = random.Random(3)
    x, y, z = prose(rng, 120), prose(rng, 120), prose(rng, 120)
    near = lambda t: " ".join(["edited", *t.split(" ")[1:]])
    line = prose(rng, 20)
    rows = [(3, x + " extra", "aa", "s", 1), (5, x, "aa", "s", 1), (5, y, "aa", "s", 1), (8, z, "aa", "s", 1), (8, near(z), "aa", "s", 1),
            (9, line + "\n" + prose(rng, 60), "aa", "s", 1), (9, line + "\n" + prose(rng, 61), "aa", "s", 1)]
    df = docs_frame(spark, rows)
    kept = [(r["doc_id"], r["text"]) for r in cp.near_dedup(spark, df, str(tmp_path)).collect()]
    assert sorted(k for k, _ in kept) == [3, 5, 8, 9, 9] and (5, y) in kept
    lines = [r["text"] for r in cp.line_dedup_stage(spark, df, str(tmp_path)).collect()]
    assert sum(t.count(line) for t in lines) == 1
