"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL

TABLES = sorted(p.stem for p in Path(SF_SMALL).glob("*.parquet"))


DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "array<bigint>": "BIGINT[]"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted(v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "adj_close" in df.columns


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in cur.description}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert DUCK.get(t, t) == otypes[f.name], (f.name, t, otypes[f.name])
    assert _rows(df.columns, got) == _rows(ocols, exp)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_reruns_agree(spark, name):
    """What SQL cannot express is compared with plain versions elsewhere; here, that a second run returns the same rows."""
    first, second = (queries()[name](spark, SF_SMALL) for _ in range(2))
    assert first.schema == second.schema
    rows = _rows(first.columns, [tuple(r) for r in first.collect()])
    assert rows and rows == _rows(second.columns, [tuple(r) for r in second.collect()])
