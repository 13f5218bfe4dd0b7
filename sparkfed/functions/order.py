"""Null placement: ascending order has nulls last, descending first, and it is always written out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pg_order(*keys: str | Column) -> list[Column]:
    """Sort keys with the host's default null placement. A name with a leading '-' sorts descending."""
    out = []
    for k in keys:
        if isinstance(k, str):
            out.append(F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k).asc_nulls_last())
        else:
            out.append(k)
    return out


def asc(c: Column) -> Column:
    return c.asc_nulls_last()


def desc(c: Column) -> Column:
    return c.desc_nulls_first()
