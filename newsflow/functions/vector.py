"""Vector math as column expressions (math in DOUBLE)."""

from __future__ import annotations

from . import sql as S
from ._expr import col, sql_of


def dot(a, b):
    return col(S.dot(sql_of(a), sql_of(b)))


def norm(v):
    return col(S.norm(sql_of(v)))


def cosine_similarity(a, b):
    """cos(a, b); NULL when a norm is zero or a side is NULL."""
    return col(S.cosine_similarity(sql_of(a), sql_of(b)))
