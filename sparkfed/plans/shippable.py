"""Which expressions a source may evaluate. A base table's WHERE is the loose context; join conditions, grouping,
aggregates, HAVING, ORDER BY and LIMIT are strict. The answer is a report: Spark computes everything either way."""

from __future__ import annotations

from . import expr as E


def shippable(e: E.Expr, strict: bool) -> bool:
    if isinstance(e, (E.Col, E.Const, E.Param)):
        return True
    if isinstance(e, E.Op):
        known = e.op in E.COMPARE + E.ARITHMETIC or (not strict and e.op in E.LOOSE)
    elif isinstance(e, (E.Bool, E.IsNull, E.Truth, E.Distinct)):
        known = True
    elif isinstance(e, E.Func):
        known = not strict and e.of is None and e.name in E.FUNCTIONS and e.name not in E.LOCAL
    elif isinstance(e, (E.In, E.Array, E.Subscript, E.Cast)):
        known = not strict
    elif isinstance(e, E.Agg):
        known = strict and e.name in E.AGGREGATES and e.where is None
    else:  # CASE, whole rows, and what is not known
        known = False
    return known and all(shippable(p, strict) for p in e.parts())
