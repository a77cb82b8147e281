"""Every registered query on empty tables (same schemas): no errors, and the oracle agrees."""

from __future__ import annotations

import os

import pytest

from ledgerlight.plans.catalog import load_all
from ledgerlight.session import scratch_path
from ledgerlight.sources.tables import TABLES
from oracle import compare, duck

from conftest import SF001

REG = load_all()


@pytest.fixture(scope="module")
def empty_dir(spark):
    d = scratch_path(spark, "test", "empty_tables")
    for t in TABLES:
        src = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(src):
            spark.read.parquet(src).limit(0).coalesce(1).write.parquet(os.path.join(d, f"{t}.parquet"))
    return d


@pytest.mark.parametrize("name", sorted(REG))
def test_query_on_empty_tables(spark, empty_dir, name):
    q = REG[name]
    df = q.build(spark, empty_dir)
    if q.sql is None:
        assert df.count() == 0
        return
    ok, msg = compare(df, duck(empty_dir), q.sql)
    assert ok, msg
