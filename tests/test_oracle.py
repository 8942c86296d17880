"""Every registered query against its DuckDB oracle on the smallest tables.

The driver runs the same comparison at sf0.01; set NEWSFLOW_ORACLE_SF to
change the directory here.
"""

import math
import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

SF = os.environ.get("NEWSFLOW_ORACLE_SF", SF_SMALL)
SQLS = entry.oracle_sql()
QUERIES = entry.queries()


def _norm(v):
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 6))
    return "NULL" if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_key_has_a_query():
    assert set(SQLS) <= set(QUERIES)
    assert len(QUERIES) >= 80


TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(SQLS))
def test_oracle(spark, duck, key):
    if SF != SF_SMALL:
        pytest.skip("oracle views are registered for sf0.001")
    df = QUERIES[key](spark, SF)
    rel = duck.sql(SQLS[key])
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "similarity_score" in df.columns
