"""LIMIT and OFFSET as the host reads them: ALL and NULL mean none, text numbers count, arithmetic of constants is folded,
negative ones are errors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans import expr as E


def folded(e: E.Expr, what: str) -> int | float | str | None:
    """The value of constants and their sums, differences and products; null if any is."""
    if isinstance(e, (E.Const, E.Param)):
        return e.value
    if not (isinstance(e, E.Op) and e.op in ("+", "-", "*")):
        raise ValueError(f"the argument of {what} must not contain variables")
    a, b = folded(e.left, what), folded(e.right, what)
    if a is None or b is None:
        return None
    return a + b if e.op == "+" else a - b if e.op == "-" else a * b


def normalise(value: int | float | str | E.Expr | None, what: str = "LIMIT") -> int | None:
    if isinstance(value, E.Expr):
        value = folded(value, what)
    if value is None or (isinstance(value, str) and value.strip().upper() in ("ALL", "NULL")):
        return None
    try:
        n = int(value) if not isinstance(value, float) else round(value)
    except ValueError:
        raise ValueError(f'invalid input for {what}: "{value}" is not a number') from None
    if n < 0:
        raise ValueError(f"{what} must not be negative")
    return n


def limit_offset(df: DataFrame, limit: int | str | E.Expr | None = None, offset: int | str | E.Expr | None = None) -> DataFrame:
    n, m = normalise(limit, "LIMIT"), normalise(offset, "OFFSET")
    if m:
        df = df.offset(m)
    return df if n is None else df.limit(n)
