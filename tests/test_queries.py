"""Every registered query runs, and gives the rows of its SQL in DuckDB on the same tables."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lodestone.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    if isinstance(value, (float, Decimal)):
        return "nan" if math.isnan(value) else float(f"{float(value):.9g}")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in found), key=lambda r: tuple((x is None, str(type(x)) if not isinstance(x, (int, float)) else "", x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, tables, name):
    got = entry.queries()[name](spark, DATA)
    if name not in registry.ORACLE_SQL:
        assert got.columns
        got.write.format("noop").mode("overwrite").save()
        return
    want = tables.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
