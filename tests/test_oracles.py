"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001.

``tools/check_oracles.py`` runs the same comparison at any scale factor.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from ledgerlight.plans.catalog import load_all
from oracle import compare, duck

from conftest import SF001

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    q = REG[name]
    df = q.build(spark, SF001)
    if q.sql is None:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, q.sql)
    assert ok, msg


def test_entry_contract(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["alert", "labels", "start", "fires_at", "value", "action", "description"]
    assert df.count() >= 0
    qs, sqls = entry_module.queries(), entry_module.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 30
    # every oracle names its columns like the Spark query
    con = duck(SF001)
    for name, sql in sqls.items():
        assert sorted(con.sql(sql).columns) == sorted(qs[name](spark, SF001).columns), name
