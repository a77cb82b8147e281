import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlight.llm import substring_dedup as s
from ledgerlight.llm.catalog import load_corpus
from ledgerlight.llm.common import shared_path
from llm_fixtures import DOCS, WORD, awkward_docs, docs_frame, empty_docs, prose


def brute(rows, window=20):
    """Each row's number of words, removed words and rest; equal rows in any order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, _text_key(rows[i]), i))
    seen, out = set(), []
    for i in order:
        w = WORD.findall(rows[i][1] or "")
        gone = set()
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            if x in seen:
                gone.update(range(k, k + window))
            seen.add(x)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


_KEYS = {}


def _text_key(row):
    return _KEYS.get((row[0], row[1]), 0)


def _learn_keys(spark, rows):
    """The operator orders rows of one id by a hash of the text: take it from Spark."""
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    for r in df.select("*", F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull()).alias("k")).collect():
        _KEYS[(r["doc_id"], r["text"])] = r["k"]


def digest(df):
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return sorted(map(tuple, df.select("doc_id", "n_words", n, F.sha2("kept_text", 256)).collect()), key=repr)


def shared_passages(seed=5):
    rng = random.Random(seed)
    hot, warm = prose(rng, 60), prose(rng, 25)
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randint(0, 60))]
        if i % 3 == 0:
            parts += [hot, prose(rng, rng.randint(0, 30))]
        if i % 7 == 0:
            parts += [warm, warm]
        if i % 11 == 0:     # a passage of 19 words is no window; overlapping repeats within one text
            parts.append(" ".join(hot.split()[:19]) + " . " + "la la " * 30)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts), "aa", "s1", 1))
    return rows


def test_query_equals_brute_force(spark):
    rows = shared_passages() + [(1000 + k, *r[1:]) for k, r in enumerate(awkward_docs()) if r[0] is not None]
    folder = shared_path(spark, "substring-test").removeprefix("file:")
    docs_frame(spark, rows).repartition(9).write.parquet(folder + "/documents.parquet")
    got = load_corpus()["op12_substring_dedup"][0](spark, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = awkward_docs() + [(5, "other words " * 20, "aa", "s1", 1)] + [(None, prose(random.Random(k % 3), 50), None, None, None) for k in range(9)]
    _learn_keys(spark, rows)
    assert digest(s.remove_repeats(docs_frame(spark, rows))) == brute(rows)


def test_small_chunks_and_pieces_change_nothing(spark):
    rows = shared_passages(6) + [(500, " ".join([prose(random.Random(1), 300)] * 5), "aa", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for limits in ((100, 64), (700, 1 << 22)):
        assert digest(s.remove_repeats(df, limits=limits)) == brute(rows)
    assert digest(s.remove_repeats(df, window=3, anchor=3)) == brute(rows, 3)


def test_spans_and_empty_table(spark):
    w = [f"w{i}" for i in range(40)]
    df = spark.createDataFrame([(1, " ".join(w), "a", "b", 1), (2, "x " + " ".join(w[5:30]) + " y", "a", "b", 1)], DOCS)
    got = {r["doc_id"]: r for r in s.remove_repeats(df).collect()}
    assert got[1]["removed"] == [] and got[2]["removed"] == [(1, 26)] and got[2]["kept_text"] == "x y"
    assert s.remove_repeats(empty_docs(spark)).count() == 0


def test_rolling_hash_depends_on_the_run_alone():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    y = np.concatenate([x[100:140], x[:50]])
    assert (s.rolling(x, 20, 0x9E3779B97F4A7C15)[100:121] == s.rolling(y, 20, 0x9E3779B97F4A7C15)[:21]).all()
    assert len(np.unique(s.rolling(x, 20, 0x9E3779B97F4A7C15))) == 481


def test_texts_are_shuffled_once_for_both_joins(spark):
    """The join with the anchors and the join with the repeats share one exchange of the texts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows in (shared_passages(), shared_passages() + shared_passages()[:1] + [(None, "a b c", None, None, None)]):
            out = s.remove_repeats(docs_frame(spark, rows))
            assert out.count() == len(rows)
            out.collect()
            assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
