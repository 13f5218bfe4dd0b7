"""Queries sent over JDBC to a real server, which Spark itself runs in a process of its own."""

import os
import socket
import subprocess
import sys
import time

import pytest
from conftest import DEPT_COLUMNS, EMP_COLUMNS
from test_spec import ALL_ON, DEPT, EMP, ON, WHOLE, d, e, spec

from sparkfed.catalog import Catalog, OptionError
from sparkfed.plans import expr as E
from sparkfed.plans.explain import run
from sparkfed.plans.spec import Join, QuerySpec, Table
from sparkfed.settings import Settings
from sparkfed.sources.readers import open_table

SERVER = """
import sys
from pyspark.sql import SparkSession
port, emp, dept, wh = sys.argv[1:]
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
b = b.config("spark.hadoop.hive.server2.thrift.port", port).config("spark.hadoop.hive.server2.thrift.bind.host", "127.0.0.1")
b = b.config("spark.hadoop.hive.server2.authentication", "NOSASL").config("spark.sql.hive.thriftServer.singleSession", "true")
b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", wh)
spark = b.getOrCreate()
for name, at in (("emp", emp), ("dept", dept)):
    spark.read.parquet(at).write.mode("overwrite").saveAsTable(name)
spark.sparkContext._jvm.org.apache.spark.sql.hive.thriftserver.HiveThriftServer2.startWithContext(spark._jsparkSession.sqlContext())
print("ready", flush=True)
sys.stdin.read()
"""


@pytest.fixture(scope="module")
def far(spark, catalog, tmp_path_factory):
    """emp and dept at a server that is reached over JDBC alone."""
    at = tmp_path_factory.mktemp("far")
    for name in ("emp", "dept"):
        open_table(spark, catalog, name).write.parquet(f"file://{at}/{name}")
    (at / "server.py").write_text(SERVER)
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        port = str(s.getsockname()[1])
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "PYSPARK_SUBMIT", "_PYSPARK"))}
    log = open(at / "log", "w")
    p = subprocess.Popen([sys.executable, str(at / "server.py"), port, f"file://{at}/emp", f"file://{at}/dept", str(at / "wh")], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=log, text=True, cwd=at, env=env)
    assert p.stdout.readline().strip() == "ready", (at / "log").read_text()[-2000:]
    time.sleep(1)
    c = Catalog()
    c.create_server("far", client_type="spark", host="127.0.0.1", port=port)
    c.create_table("emp", "far", EMP_COLUMNS, format="jdbc")
    c.create_table("dept", "far", DEPT_COLUMNS, format="jdbc")
    c.create_table("emp_ranges", "far", EMP_COLUMNS, format="jdbc", table_name="emp", partition_column="empno", lower_bound="1", upper_bound="7", num_partitions="3")
    yield c
    p.stdin.close()
    p.wait(60)
    log.close()


def rows(df):
    return sorted(map(repr, df.collect()))


def sent(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("n", range(len(WHOLE)))
def test_whole_queries(spark, catalog, far, n):
    """Everything that the report calls remote is, and rows and types are those of Spark alone."""
    q = WHOLE[n]
    got, want = q.dataframe(spark, far, ALL_ON), q.dataframe(spark, catalog)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows(got) == rows(want)
    plan = sent(got)
    assert plan.count("JDBCRelation") == 1 and "Join" not in plan and "Aggregate" not in plan


PARTS = [
    spec(where=[E.Op(">", e("sal"), E.Const(1000))], order=[(e("sal"), True, None), (e("empno"), False, None)], limit=3),
    QuerySpec(Join("inner", EMP, DEPT, ON), [(d("dname"), "dname"), (E.Agg("sum", e("sal")), "s")], group=[d("dname")], order=[(d("dname"), False, None)], limit=2, offset=1),
    QuerySpec(EMP, [(E.Agg("count"), "n")]),
    QuerySpec(Join("semi", EMP, DEPT, ON), two := [(e("empno"), "empno")]),
    QuerySpec(Join("anti", EMP, DEPT, ON), two),
    QuerySpec(EMP, [(E.Row("e"), "r"), (e("empno"), "n")]),
]
SWITCHES = [Settings(), ALL_ON, Settings(enable_join_pushdown=False), Settings(enable_aggregate_pushdown=False), Settings(enable_limit_pushdown=False)]


@pytest.mark.parametrize("settings", SWITCHES)
def test_switches_keep_rows(spark, catalog, far, settings):
    for q in PARTS:
        got, want = run(spark, far, q, settings), q.dataframe(spark, catalog)
        assert got.schema.simpleString() == want.schema.simpleString() and rows(got) == rows(want)
        if q.order:
            assert got.collect() == want.collect()


def test_aggregate_switched_off_leaves_join_remote(spark, far):
    plan = sent(PARTS[1].dataframe(spark, far, Settings(enable_aggregate_pushdown=False)))
    assert "Aggregate" in plan and "Join" not in plan and plan.count("JDBCRelation") == 1


def test_ranges(spark, catalog, far):
    got = open_table(spark, far, "emp_ranges")
    assert got.rdd.getNumPartitions() == 3 and rows(got) == rows(open_table(spark, catalog, "emp"))
    q = QuerySpec(Table("emp_ranges", "e"), [(E.Agg("sum", e("sal")), "s")])
    assert q.dataframe(spark, far, Settings(enable_aggregate_pushdown=False)).collect() == QuerySpec(EMP, q.select).dataframe(spark, catalog).collect()


def test_ranges_are_given_together():
    c = Catalog()
    c.create_server("s")
    c.create_table("t", "s", [("a", "int")], format="jdbc", partition_column="a")
    with pytest.raises(OptionError, match="together"):
        c.resolve("t")
