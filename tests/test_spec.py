"""Query specs: rows, reports, and remote text that gives the same rows."""

import datetime as dt
import logging

import pytest

from sparkfed.functions.limits import normalise
from sparkfed.functions.order import pg_order
from sparkfed.functions.rewrite import array_agg, hypothetical_rank, int_div, round_half_even, trunc
from sparkfed.plans import expr as E
from sparkfed.plans.explain import explain, rewrite_quantified, run, strip_row_locks
from sparkfed.plans.shippable import shippable
from sparkfed.plans.spec import Join, QuerySpec, Table
from sparkfed.plans.stats import analyze, estimated_rows, sample_rows, size_in_bytes, vacuum
from sparkfed.settings import Settings

e = lambda n: E.Col("e", n)
d = lambda n: E.Col("d", n)
EMP, DEPT = Table("emp", "e"), Table("dept", "d")
ON = (E.Op("=", e("deptno"), d("deptno")),)
ALL_ON = Settings(enable_order_by_pushdown=True)
two = [(e("empno"), "empno"), (e("sal"), "sal")]


def spec(**k):
    return QuerySpec(**({"source": EMP, "select": two} | k))


WHOLE = [
    spec(where=[E.Op(">", e("sal"), E.Const(1000)), E.Op("=", e("hiredate"), E.Const(dt.date(2002, 3, 4)))]),
    spec(where=[E.Op("ILIKE", e("job"), E.Const("SAL%"))]),
    spec(where=[E.Op("~", e("ename"), E.Const("^[a-c]"))]),
    spec(where=[E.Op("!~*", e("ename"), E.Const("^[A-C]"))]),
    spec(where=[E.In(e("job"), ("clerk", "it's, \\ odd"))]),
    spec(where=[E.In(e("empno"), (1, 2), True)]),
    spec(where=[E.Distinct(e("comm"), E.Const(0))]),
    spec(where=[E.IsNull(e("mgr")), E.Bool("NOT", (E.Op("=", e("job"), E.Const("clerk")),))]),
    spec(where=[E.Op("=", E.Op("/", e("sal"), E.Const(100), True), E.Const(12))]),
    spec(where=[E.Op("=", E.Op("^", e("empno"), E.Const(2)), E.Const(9.0))]),
    spec(where=[E.Op("=", E.Func("upper", (e("ename"),)), E.Const("BOB"))]),
    spec(where=[E.Op("=", E.Subscript(E.Array((e("empno"), e("sal"))), 2), E.Const(800))]),
    spec(where=[E.Op("=", E.Func("trunc", (E.Op("/", e("sal"), E.Const(1000)),)), E.Const(1))]),
    spec(where=[E.Op("=", e("deptno"), E.Param("p", 20))]),
    QuerySpec(Join("inner", EMP, DEPT, ON), [(e("ename"), "ename"), (d("dname"), "dname")], where=[E.Op("=", d("loc"), E.Const("leeds"))]),
    QuerySpec(Join("left", EMP, DEPT, ON), [(e("ename"), "ename"), (d("dname"), "dname")]),
    QuerySpec(Join("right", EMP, DEPT, ON), [(e("ename"), "ename"), (d("dname"), "dname")]),
    QuerySpec(Join("full", EMP, DEPT, ON), [(e("ename"), "ename"), (d("dname"), "dname")]),
    QuerySpec(Join("inner", EMP, DEPT), [(e("ename"), "ename"), (d("dname"), "dname")]),
    QuerySpec(Join("left", EMP, Join("inner", DEPT, Table("emp", "m"), (E.Op("=", d("deptno"), E.Col("m", "deptno")),)), ON), [(e("ename"), "a"), (E.Col("m", "ename"), "b")]),
    QuerySpec(EMP, [(e("deptno"), "deptno"), (E.Agg("count"), "n"), (E.Agg("sum", e("sal")), "s"), (E.Agg("avg", e("comm")), "a"), (E.Agg("count", e("job"), True), "j")], group=[e("deptno")], having=[E.Op(">", E.Agg("min", e("sal")), E.Const(100))]),
    QuerySpec(EMP, [(E.Agg("max", e("sal")), "m")]),
    QuerySpec(EMP, [(E.Agg("max", e("sal")), "m")], group=[E.Const(1), e("job")]),
    QuerySpec(Join("inner", EMP, DEPT, ON), [(d("dname"), "dname"), (E.Op("*", E.Agg("sum", e("sal")), E.Const(2)), "s")], group=[d("dname")], order=[(d("dname"), True, None)], limit=2),
    spec(order=[(e("comm"), False, None), (e("empno"), False, None)], limit=4, offset=1),
    spec(order=[(E.Op("*", e("sal"), E.Const(-1)), True, True), (e("empno"), False, None)], limit="3"),
    spec(where=[E.Op("LIKE", e("ename"), E.Func("concat", (E.Func("left", (e("ename"), E.Const(1))), E.Const("%"))))]),
    spec(where=[E.Op("~*", e("job"), E.Func("upper", (E.Func("left", (e("job"), E.Const(2))),)))]),
    spec(where=[E.Op("=", E.Op("<<", e("empno"), e("empno")), E.Const(8))]),
    spec(where=[E.Op("=", E.Func("mod", (e("sal"), E.Const(100))), E.Const(50)), E.Op(">", E.Func("round", (e("sal"), E.Const(-3))), E.Const(0))]),
    spec(where=[E.Op("=", E.Func("coalesce", (e("mgr"), E.Const(0))), E.Const(0)), E.Op("=", E.Func("lpad", (e("job"), E.Const(2), E.Const("x"))), E.Const("bo"))]),
    spec(where=[E.Truth(E.Op(">", e("mgr"), E.Const(3)), "TRUE", True), E.Truth(E.Op(">", e("mgr"), E.Const(3)), "UNKNOWN")]),
]


@pytest.mark.parametrize("i", range(len(WHOLE)))
def test_remote_text_gives_the_same_rows(spark, catalog, i):
    r = WHOLE[i].report(catalog, ALL_ON)
    assert len(r.remote) == 1 and not r.local, r
    want = sorted(map(tuple, WHOLE[i].dataframe(spark, catalog).collect()), key=repr)
    assert sorted(map(tuple, spark.sql(r.remote[0]).collect()), key=repr) == want and (want or i == 99)


def test_switches_change_the_report_only(spark, catalog):
    q = WHOLE[23]
    off = Settings(False, False, False, False)
    assert q.report(catalog, ALL_ON).pushed == {"join", "aggregate", "order", "limit"}
    assert len(q.report(catalog, off).remote) == 2 and not q.report(catalog, off).pushed
    assert run(spark, catalog, q, off).collect() == run(spark, catalog, q, ALL_ON).collect()


def test_contexts():
    like = E.Op("LIKE", e("job"), E.Const("a%"))
    assert shippable(like, False) and not shippable(like, True)
    assert not shippable(E.Func("random"), False) and not shippable(E.Case(((like, E.Const(1)),)), False)
    assert not shippable(E.Func("f", (e("job"),), of=lambda c: c), False)
    assert shippable(E.Agg("sum", e("sal")), True) and not shippable(E.Agg("stddev", e("sal")), True)
    assert not shippable(E.Agg("sum", e("sal"), where=E.IsNull(e("comm"))), True)


def test_local_parts(catalog):
    q = QuerySpec(Join("semi", EMP, DEPT, ON), two)
    assert q.report(catalog).local == ["semi join"] and len(q.report(catalog).remote) == 2
    q = spec(where=[E.Op("=", E.Func("random"), E.Const(1))], limit=3)
    assert q.report(catalog).local == ["filter", "limit"]
    q = QuerySpec(EMP, [(E.Agg("count"), "n")], group=[e("job")], having=[E.Op(">", E.Func("sqrt", (E.Agg("count"),)), E.Const(1))], limit=1)
    assert q.report(catalog).local == ["having", "limit"]


def test_dialects(catalog):
    q = spec(limit=5, offset=2)
    assert q.report(catalog).remote[0].endswith(" LIMIT 5 OFFSET 2")
    catalog.alter("server", "files", set_={"client_type": "hiveserver2"})
    try:
        assert q.report(catalog).remote[0].endswith(" LIMIT 2, 5")
        assert spec(offset=2).report(catalog).local == ["limit"]
    finally:
        catalog.alter("server", "files", set_={"client_type": "spark"})


def test_whole_row(spark, catalog):
    q = QuerySpec(Join("full", EMP, DEPT, ON), [(E.Row("e"), "e"), (E.Row("d"), "d")])
    got = q.dataframe(spark, catalog).collect()
    assert sum(r["e"] is None for r in got) == 1 and sum(r["d"] is None for r in got) == 1
    assert next(r for r in got if r["e"] is None)["d"]["dname"] == "none"


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert [r["a"] for r in df.orderBy(*pg_order("a")).collect()] == [1, 2, None]
    assert [r["a"] for r in df.orderBy(*pg_order("-a")).collect()] == [None, 2, 1]


@pytest.mark.parametrize("v,want", [(None, None), ("ALL", None), ("NULL", None), ("5", 5), (0, 0)])
def test_limits(v, want):
    assert normalise(v) == want


def test_bad_limits():
    with pytest.raises(ValueError, match="LIMIT must not be negative"):
        normalise(-1)
    with pytest.raises(ValueError, match="not a number"):
        normalise("abc")


def test_rewrites(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(7, 2, 2.5), (-7, 2, 3.5), (None, 2, -1.7)], "a int, b int, c double")
    assert [r[0] for r in df.select(int_div(df.a, df.b)).collect()] == [3, -3, None]
    assert [r[0] for r in df.select(round_half_even(df.c)).collect()] == [2.0, 4.0, -2.0]
    assert [r[0] for r in df.select(trunc(df.c)).collect()] == [2, 3, -1]
    # 1 + the number of rows before 7 in (-7, 7, null): ranks by hand
    assert df.agg(hypothetical_rank(F.lit(7), df.a)).first()[0] == 2
    assert sorted(df.agg(array_agg(df.a)).first()[0], key=str) == [-7, 7, None]


def test_statements():
    assert strip_row_locks("SELECT 1 FOR UPDATE") == "SELECT 1" and strip_row_locks("SELECT a FROM t FOR SHARE OF t NOWAIT;") == "SELECT a FROM t"
    assert rewrite_quantified("a = ANY (SELECT 1) AND b <> ALL(SELECT 2)") == "a IN (SELECT 1) AND b NOT IN (SELECT 2)"


def test_stats_and_explain(spark, catalog, caplog):
    analyze(spark, catalog, "emp")
    assert estimated_rows(spark, catalog, "emp") == 1000 and size_in_bytes(spark, catalog, "emp") > 0
    text = explain(spark, catalog, spec(where=[E.Op("=", e("deptno"), E.Param("p", 20))]))
    assert "Relations: e" in text and "= ?" in text and "Physical Plan" in text
    catalog.alter("server", "files", add={"log_remote_sql": "true"})
    try:
        with caplog.at_level(logging.INFO, "sparkfed"):
            run(spark, catalog, spec()).collect()
        assert "Remote SQL: SELECT" in caplog.text
    finally:
        catalog.alter("server", "files", drop=["log_remote_sql"])


def test_null_parameter_matches_nothing(spark, catalog):
    assert spec(where=[E.Op("=", e("deptno"), E.Param("p", None))]).dataframe(spark, catalog).count() == 0


def test_first_match_is_replaced_here(spark, catalog):
    """regexp_replace means the first match only, which sources do not do: it stays local."""
    q = spec(where=[E.Op("=", E.Func("regexp_replace", (e("ename"), E.Const("([a-e])"), E.Const("z"))), E.Const("zve"))])
    assert q.report(catalog, ALL_ON).local == ["filter"] and q.dataframe(spark, catalog).count() == 1


def test_limit_of_an_expression(spark, catalog):
    two_more = E.Op("+", E.Const(1), E.Op("*", E.Const(1), E.Param("p", 1)))
    q = spec(order=[(e("empno"), False, None)], limit=two_more, offset=E.Op("-", E.Const(3), E.Const(2)))
    assert [r["empno"] for r in q.dataframe(spark, catalog).collect()] == [2, 3]
    assert "LIMIT 2 OFFSET 1" in q.report(catalog, ALL_ON).remote[0]
    assert normalise(E.Op("+", E.Const(1), E.Const(None))) is None
    with pytest.raises(ValueError, match="variables"):
        normalise(e("empno"))
    with pytest.raises(ValueError, match="negative"):
        normalise(E.Op("-", E.Const(1), E.Const(2)), "OFFSET")


def test_bare_parameter_keeps_an_aggregate_local(catalog):
    q = QuerySpec(EMP, [(e("job"), "job"), (E.Param("p", 3), "p"), (E.Agg("count"), "n")], group=[e("job")])
    assert "aggregate" in q.report(catalog).local
    inside = QuerySpec(EMP, [(e("job"), "job"), (E.Op("+", E.Agg("sum", e("sal")), E.Param("p", 3)), "s")], group=[e("job")])
    assert "aggregate" in inside.report(catalog).pushed


def test_joins_across_servers():
    from sparkfed.catalog import Catalog

    c = Catalog()
    for server, kind in (("a", "spark"), ("b", "spark"), ("h", "hiveserver2")):
        c.create_server(server, client_type=kind)
        c.create_table("t" + server, server, [("k", "int")])
    joined = lambda x, y: QuerySpec(Join("inner", Table(x, "x"), Table(y, "y"), (E.Op("=", E.Col("x", "k"), E.Col("y", "k")),)), [(E.Col("x", "k"), "k")])
    assert "join (different servers)" in joined("ta", "tb").report(c).local
    with pytest.raises(ValueError, match="client_type"):
        joined("ta", "th").report(c)


def test_right_lateral_is_an_error(spark):
    with pytest.raises(Exception):
        spark.sql("SELECT * FROM VALUES (1) a(x) RIGHT JOIN LATERAL (SELECT a.x + 1 AS y) b ON true").collect()


def test_vacuum_and_samples(spark, catalog):
    assert vacuum(spark, catalog, "emp", analyze_too=True) is None
    with pytest.raises(ValueError, match="does not exist"):
        vacuum(spark, catalog, "nowhere")
    assert sample_rows(spark, catalog, "emp", 1.0).count() == 6 and sample_rows(spark, catalog, "emp", 0.0).count() == 0
