"""Queries against their DuckDB SQL, and the registry's contract."""

import pytest
from conftest import SF_MEDIUM, SF_SMALL

import __spark_entry__ as entry
from tierlake.llm.queries import ORACLE, QUERIES
from tools.check_oracle import compare, duck_connect


def test_registered():
    assert [n for n in QUERIES if n.startswith("op")] == sorted(
        (n for n in QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf, key):
    con = duck_connect(sf)
    status, detail = compare(QUERIES[key](spark, sf), con, ORACLE[key])
    assert status == "OK", detail
