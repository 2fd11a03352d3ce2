"""Every registered query against its SQL, as the driver compares them: columns by name, rows in any order."""

import decimal
import math
import os

import duckdb
import pytest

from skeinspark.plans.catalog import ORACLE_SQL, QUERIES


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else round(float(v), 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def order(row):
    return tuple((v is None, "n", float(v)) if isinstance(v, (int, float)) else (v is None, type(v).__name__, v) for v in row)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        path = f"{sf}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=order)
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=order)
    assert rows == wanted


def test_scrape_interval_of_moved_copies(spark, sf, duck, tmp_path):
    """Copies of a series at other times: each distance occurs as often as there are copies, whatever doubles the times make."""
    spread = f"SELECT event_id + 1000000 * i AS event_id, ts + i * INTERVAL '31 days 00:00:00.3' AS ts, user_id + 10 * i AS user_id, event_type, value, props FROM '{sf}/events.parquet', range(8) r(i)"
    duck.execute(f"COPY ({spread}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    wanted = duck.execute(ORACLE_SQL["S12_scrape_interval"].replace("FROM events", f"FROM '{tmp_path}/events.parquet'")).fetchall()
    assert [tuple(map(plain, r)) for r in QUERIES["S12_scrape_interval"](spark, str(tmp_path)).collect()] == wanted
