"""Every registered query against its DuckDB oracle (row count, columns, value hash) at sf0.001,
plus the entry-point contract."""

from __future__ import annotations

import pytest

from conftest import SF001
from oracle_compare import compare, duck

import __spark_entry__ as entry_module
from lotwise.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF001, con)
    assert res["spark_rows"] > 0
    assert name in ORACLES, "every registered query of the library's own has an oracle"
    assert entry_module.queries()[name] is QUERIES[name] and entry_module.oracle_sql()[name] == ORACLES[name]
    assert res["columns_match"], res
    assert res["oracle_rows"] == res["spark_rows"], res
    assert res["hash_match"], res


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "LOT_ID" and len(df.columns) == 18
    assert df.count() > 0
