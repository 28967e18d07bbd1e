from __future__ import annotations

import duckdb
import pytest

from salesmart.llm.oracles import ORACLES
from salesmart.llm.queries import QUERIES
from tests.llm.helpers import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    relation = con.sql(ORACLES[name])
    columns = sorted(relation.columns)
    expected = sorted(map(repr, relation.project(", ".join(columns)).fetchall()))
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == columns
    assert sorted(repr(tuple(r)) for r in found.select(columns).collect()) == expected


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_registers_them():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
