"""Expressions that are both a Spark column and, where a source may evaluate them, SQL text."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import rewrite

#: Operators that any context may send, and those that a plain WHERE may.
COMPARE, ARITHMETIC = ("=", "<>", "<", ">", "<=", ">="), ("+", "-", "*", "/", "%")
LOOSE = ("||", "^", "&", "|", "<<", ">>", "LIKE", "NOT LIKE", "ILIKE", "NOT ILIKE", "~", "~*", "!~", "!~*")
AGGREGATES = ("count", "sum", "avg", "min", "max")
#: Host functions by how Spark computes them; those of other meanings have their own expression.
FUNCTIONS = {
    "lower": F.lower, "upper": F.upper, "length": F.length, "trim": F.trim, "ltrim": F.ltrim, "rtrim": F.rtrim, "btrim": F.trim, "replace": F.replace,
    "concat": F.concat, "reverse": F.reverse, "initcap": F.initcap, "ascii": F.ascii, "md5": F.md5, "substr": F.substr, "substring": F.substr, "left": F.left, "right": F.right,
    "strpos": rewrite.strpos, "starts_with": F.startswith, "split_part": F.split_part, "abs": F.abs, "ceil": F.ceil, "floor": F.floor, "sqrt": F.sqrt, "exp": F.exp, "ln": F.log,
    "log": rewrite.log10, "trunc": rewrite.trunc, "power": F.pow, "sign": F.signum, "degrees": F.degrees, "radians": F.radians, "sin": F.sin, "cos": F.cos, "tan": F.tan, "date": F.to_date,
    "round": lambda a, *n: F.call_function("round", a, *n), "mod": lambda a, b: a % b, "lpad": lambda *a: F.call_function("lpad", *a), "rpad": lambda *a: F.call_function("rpad", *a), "repeat": lambda a, n: F.call_function("repeat", a, n),
    "coalesce": F.coalesce, "nullif": F.nullif, "greatest": F.greatest, "least": F.least, "regexp_replace": rewrite.regexp_replace_column, "date_trunc": lambda unit, a: F.call_function("date_trunc", unit, a),
    "year": F.year, "month": F.month, "day": F.day, "quarter": F.quarter, "pi": F.pi,
}
#: Their names at the source, where another.
REMOTE_NAMES = {"btrim": "trim", "strpos": "instr", "starts_with": "startswith", "log": "log10", "date": "to_date"}
#: Functions that sources lack or give another meaning: never sent.
LOCAL = {"regexp_replace", "date_trunc", "greatest", "least"}
#: Not the same for the same arguments.
MUTABLE = {"random": F.rand, "now": F.current_timestamp, "current_date": F.current_date}


class Expr:
    def column(self) -> Column:
        raise NotImplementedError

    def parts(self) -> tuple[Expr, ...]:
        return ()

    def tables(self) -> set[str]:
        return set().union(*(p.tables() for p in self.parts())) if self.parts() else set()


@dataclass(frozen=True)
class Col(Expr):
    table: str
    name: str

    def column(self) -> Column:
        return F.col(f"{self.table}.`{self.name}`")

    def tables(self) -> set[str]:
        return {self.table}


@dataclass(frozen=True)
class Const(Expr):
    value: object

    def column(self) -> Column:
        return F.lit(self.value)


@dataclass(frozen=True)
class Param(Expr):
    """A value bound when the query runs; null never equals anything."""

    name: str
    value: object = None

    def column(self) -> Column:
        return F.lit(self.value)


@dataclass(frozen=True)
class Op(Expr):
    op: str
    left: Expr
    right: Expr
    whole: bool = False  # both sides are whole numbers: / truncates

    def parts(self) -> tuple[Expr, ...]:
        return self.left, self.right

    def column(self) -> Column:
        a, b = self.left.column(), self.right.column()
        like = {"LIKE": lambda: F.like(a, b), "ILIKE": lambda: F.ilike(a, b), "~": lambda: F.rlike(a, b), "~*": lambda: F.rlike(a, F.concat(F.lit("(?i)"), b))}
        if isinstance(self.right, (Const, Param)) and self.right.value is not None:  # a constant pattern can reach the scan
            like |= {"LIKE": lambda: a.like(self.right.value), "~": lambda: a.rlike(self.right.value), "~*": lambda: a.rlike("(?i)" + self.right.value)}
        if self.op in like:
            return like[self.op]()
        if self.op in ("NOT LIKE", "NOT ILIKE", "!~", "!~*"):
            return ~like[self.op.replace("NOT ", "").replace("!", "")]()
        of = {
            "=": lambda: a == b, "<>": lambda: a != b, "<": lambda: a < b, ">": lambda: a > b, "<=": lambda: a <= b, ">=": lambda: a >= b,
            "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: rewrite.int_div(a, b) if self.whole else a / b, "%": lambda: a % b,
            "||": lambda: F.concat(a, b), "^": lambda: F.pow(a, b), "&": lambda: a.bitwiseAND(b), "|": lambda: a.bitwiseOR(b),
            "<<": lambda: F.call_function("shiftleft", a, b), ">>": lambda: F.call_function("shiftright", a, b),
        }
        return of[self.op]()


@dataclass(frozen=True)
class Bool(Expr):
    op: str  # AND, OR, NOT
    args: tuple[Expr, ...]

    def parts(self) -> tuple[Expr, ...]:
        return self.args

    def column(self) -> Column:
        out = self.args[0].column()
        for x in self.args[1:]:
            out = out & x.column() if self.op == "AND" else out | x.column()
        return ~out if self.op == "NOT" else out


@dataclass(frozen=True)
class IsNull(Expr):
    arg: Expr
    negated: bool = False

    def parts(self) -> tuple[Expr, ...]:
        return (self.arg,)

    def column(self) -> Column:
        return self.arg.column().isNotNull() if self.negated else self.arg.column().isNull()


@dataclass(frozen=True)
class Truth(Expr):
    """arg IS [NOT] TRUE, FALSE or UNKNOWN: never null."""

    arg: Expr
    what: str
    negated: bool = False

    def parts(self) -> tuple[Expr, ...]:
        return (self.arg,)

    def column(self) -> Column:
        c = self.arg.column()
        found = {"TRUE": F.coalesce(c, F.lit(False)), "FALSE": F.coalesce(~c, F.lit(False)), "UNKNOWN": c.isNull()}[self.what]
        return ~found if self.negated else found


@dataclass(frozen=True)
class Distinct(Expr):
    """left IS [NOT] DISTINCT FROM right."""

    left: Expr
    right: Expr
    negated: bool = False

    def parts(self) -> tuple[Expr, ...]:
        return self.left, self.right

    def column(self) -> Column:
        same = self.left.column().eqNullSafe(self.right.column())
        return same if self.negated else ~same


@dataclass(frozen=True)
class In(Expr):
    arg: Expr
    values: tuple[object, ...]
    negated: bool = False

    def parts(self) -> tuple[Expr, ...]:
        return (self.arg,)

    def column(self) -> Column:
        found = self.arg.column().isin(*self.values)
        return ~found if self.negated else found


@dataclass(frozen=True)
class Func(Expr):
    name: str
    args: tuple[Expr, ...] = ()
    of: object = None  # a user's function of columns

    def parts(self) -> tuple[Expr, ...]:
        return self.args

    def column(self) -> Column:
        f = self.of or FUNCTIONS.get(self.name) or MUTABLE[self.name]
        return f(*(a.column() for a in self.args))


@dataclass(frozen=True)
class Cast(Expr):
    arg: Expr
    to: str

    def parts(self) -> tuple[Expr, ...]:
        return (self.arg,)

    def column(self) -> Column:
        from ..types import spark_type

        return self.arg.column().cast(spark_type(self.to))


@dataclass(frozen=True)
class Array(Expr):
    args: tuple[Expr, ...]

    def parts(self) -> tuple[Expr, ...]:
        return self.args

    def column(self) -> Column:
        return F.array(*(a.column() for a in self.args))


@dataclass(frozen=True)
class Subscript(Expr):
    """a[i], or a[i:upto]; places count from 1."""

    arg: Expr
    at: int
    upto: int | None = None

    def parts(self) -> tuple[Expr, ...]:
        return (self.arg,)

    def column(self) -> Column:
        a = self.arg.column()
        return F.try_element_at(a, F.lit(self.at)) if self.upto is None else F.slice(a, self.at, max(0, self.upto - self.at + 1))


@dataclass(frozen=True)
class Case(Expr):
    whens: tuple[tuple[Expr, Expr], ...]
    other: Expr | None = None

    def parts(self) -> tuple[Expr, ...]:
        return tuple(x for w in self.whens for x in w) + ((self.other,) if self.other else ())

    def column(self) -> Column:
        out = F
        for c, v in self.whens:
            out = out.when(c.column(), v.column())
        return out.otherwise(self.other.column()) if self.other else out


@dataclass(frozen=True)
class Row(Expr):
    """A table's whole row."""

    table: str

    def column(self) -> Column:
        return F.col(f"{self.table}._row")

    def tables(self) -> set[str]:
        return {self.table}


@dataclass(frozen=True)
class Agg(Expr):
    name: str
    arg: Expr | None = None  # none: count(*)
    distinct: bool = False
    where: Expr | None = None

    def parts(self) -> tuple[Expr, ...]:
        return tuple(x for x in (self.arg, self.where) if x is not None)

    def column(self) -> Column:
        c = self.arg.column() if self.arg is not None else F.lit(1)
        if self.where is not None:
            c = F.when(self.where.column(), c)
        if self.distinct:
            return {"count": F.count_distinct, "sum": F.sum_distinct}.get(self.name, getattr(F, self.name))(c)
        return getattr(F, self.name)(c)


def literal(value: object) -> str:
    """A typed SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
