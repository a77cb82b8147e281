"""Every registered query against its DuckDB form, and on empty tables."""

import os

import pytest

from conftest import SF001
from ledgerlight.llm.catalog import load_corpus
from ledgerlight.llm.common import shared_path
from oracle import compare, duck

CORPUS = load_corpus()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in CORPUS.items() if sql))
def test_query_matches_oracle(spark, name):
    build, sql = CORPUS[name]
    ok, msg = compare(build(spark, SF001), duck(SF001), sql)
    assert ok, msg


@pytest.fixture(scope="module")
def empty_dir(spark):
    d = shared_path(spark, "empty").removeprefix("file:")
    for t in ("documents", "embeddings", "pages", "labels"):
        spark.read.parquet(os.path.join(SF001, f"{t}.parquet")).limit(0).coalesce(1).write.parquet(os.path.join(d, f"{t}.parquet"))
    return d


@pytest.mark.parametrize("name", sorted(CORPUS))
def test_query_on_empty_tables(spark, empty_dir, name):
    assert CORPUS[name][0](spark, empty_dir).count() == 0


def test_entry_lists_them():
    import __spark_entry__ as e

    assert {"pipeline", *CORPUS} <= set(e.queries())
    assert {n.split("_")[0] for n in CORPUS} == {f"op{i}" for i in range(1, 14)}
