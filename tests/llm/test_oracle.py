"""The training-data queries that SQL can express, against their SQL in DuckDB."""

import os

import duckdb
import pytest

from skeinspark.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(name, sf, spark):
    folder, con = f"/root/testdata/{sf}", duckdb.connect()
    for x in os.listdir(folder):
        con.execute(f"CREATE VIEW {x.split('.')[0]} AS SELECT * FROM '{folder}/{x}'")
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    found = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == want
