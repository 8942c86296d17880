"""Column <-> SQL text adapters for the column-function modules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sql import ident

_SIMPLE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*$")
_COLREPR = re.compile(r"^Column<'([A-Za-z_][A-Za-z0-9_.]*)'>$")


def sql_of(x) -> str:
    """SQL text of an argument: a column name (``a`` or ``a.b``), SQL text, a
    Column returned by these modules, or a plain ``F.col(name)``."""
    if isinstance(x, str):
        return ident(x) if _SIMPLE.match(x) else x
    sql = vars(x).get("_nf_sql") if hasattr(x, "__dict__") else None
    if sql is not None:
        return sql
    m = _COLREPR.match(str(x))
    if m:
        return ident(m.group(1))
    try:                                   # any other Column: its SQL text (one JVM call)
        return "(" + x._jc.node().sql() + ")"
    except Exception as e:  # noqa: BLE001
        raise TypeError(f"pass a column name or SQL text instead of {x!r}") from e


def col(sql: str) -> Column:
    """One ``expr`` call; the SQL text rides along for further composition."""
    c = F.expr(sql)
    c._nf_sql = sql
    return c
