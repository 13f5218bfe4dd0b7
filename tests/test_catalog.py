import datetime as dt

import pytest

from sparkfed.catalog import Catalog, OptionError
from sparkfed.sources.readers import jdbc_url, open_partitions, open_table
from sparkfed.types import CoercionError, UnsupportedTypeError, bindable, coerced, spark_type


def test_options():
    c = Catalog()
    with pytest.raises(OptionError, match="valid options for a server"):
        c.create_server("s", nonsense="1")
    for bad in ("0", "65535", "x"):
        with pytest.raises(OptionError, match="invalid port number"):
            c.create_server("s", port=bad)
    with pytest.raises(OptionError):
        c.create_server("s", client_type="other")
    with pytest.raises(OptionError):
        c.create_server("s", query_timeout="0")
    c.create_server("s", port="10001", client_type="SPARK", enable_join_pushdown="false", auth_type="LDAP")
    c.create_table("t", "s", [("a", "int")], enable_join_pushdown="true", table_name="far")
    with pytest.raises(OptionError, match="user name"):
        c.resolve("t")
    c.create_user_mapping("s", username="u", password="p")
    o = c.resolve("t")
    assert (o["port"], o["client_type"], o["enable_join_pushdown"], o["table_name"], o["dbname"], o["fetch_size"]) == (10001, "spark", True, "far", "default", 10000)
    assert jdbc_url(o) == "jdbc:hive2://localhost:10001/default"


def test_alter_and_drop():
    c = Catalog()
    c.create_server("s")
    c.create_table("t", "s", [("a", "int")])
    c.alter("server", "s", add={"host": "h"})
    with pytest.raises(OptionError, match="more than once"):
        c.alter("server", "s", add={"host": "h"})
    c.alter("server", "s", set_={"host": "g"}, drop=[])
    assert c.resolve("t")["host"] == "g"
    c.alter("server", "s", drop=["host"])
    with pytest.raises(OptionError, match="not found"):
        c.alter("server", "s", drop=["host"])
    c.rename_table("t", "u")
    assert c.resolve("u")["table_name"] == "t"
    with pytest.raises(OptionError, match="depend"):
        c.drop_server("s")
    c.drop_server("s", cascade=True)
    assert not c.tables


def test_user_mappings_owners_and_server_names():
    c = Catalog()
    c.create_server("s")
    c.create_table("t", "s", [("a", "int")])
    with pytest.raises(OptionError, match="does not exist"):
        c.alter_user_mapping("s", add={"username": "u"})
    c.create_user_mapping("s", username="u")
    c.alter_user_mapping("s", add={"password": "p"}, set_={"username": "w"})
    assert (c.resolve("t")["username"], c.resolve("t")["password"]) == ("w", "p")
    with pytest.raises(OptionError, match="valid options for a user"):
        c.alter_user_mapping("s", add={"host": "h"})
    c.rename_server("s", "far")
    assert c.tables["t"].server == "far" and c.resolve("t")["username"] == "w"
    c.create_server("s")
    with pytest.raises(OptionError, match="already exists"):
        c.rename_server("s", "far")
    c.set_owner("server", "far", "ann")
    c.set_owner("table", "t", "bob")
    assert (c.servers["far"].owner, c.tables["t"].owner) == ("ann", "bob")
    c.drop_user_mapping("far")
    assert c.resolve("t")["username"] is None
    with pytest.raises(OptionError, match="does not exist"):
        c.drop_user_mapping("far")


@pytest.mark.parametrize("name", ["money", "inet", "point", "json", "interval", "int[]", "circle"])
def test_unsupported(name):
    with pytest.raises(UnsupportedTypeError):
        spark_type(name)


def test_bindable():
    assert bindable("numeric(7,2)") and bindable("date") and not bindable("bytea") and not bindable("time")


def test_text_table(spark, catalog):
    got = {r["empno"]: r for r in open_table(spark, catalog, "emp_text").collect()}
    assert len(got) == 6 and got[4]["mgr"] is None and got[1]["comm"] is None and got[5]["comm"] == 0
    assert got[1]["hiredate"] == dt.date(2001, 2, 3) and got[6]["deptno"] is None


GOOD = [("1", "string", "int", 1), ("1980-12-17 01:23:23", "string", "date", dt.date(1980, 12, 17)), ("", "string", "int", None), ("", "string", "text", None), (7, "int", "varchar(1)", "7"), (7369, "int", "bytea", b"7369"), ("01:02:03", "string", "time", "01:02:03"), (True, "boolean", "text", "true"), (5, "tinyint", "smallint", 5)]


@pytest.mark.parametrize("value,source,declared,want", GOOD)
def test_coercion(spark, value, source, declared, want):
    df = spark.createDataFrame([(value,)], f"a {source}")
    got = df.select(coerced(df["a"], df.schema["a"].dataType, declared).alias("a")).first()["a"]
    assert (bytes(got) if isinstance(want, bytes) else got) == want


@pytest.mark.parametrize("source,declared", [("int", "boolean"), ("int", "timestamp"), ("int", "date"), ("date", "boolean"), ("boolean", "date"), ("date", "time")])
def test_refused(spark, source, declared):
    df = spark.createDataFrame([], f"a {source}")
    with pytest.raises(CoercionError):
        coerced(df["a"], df.schema["a"].dataType, declared)


def test_bad_values(spark):
    df = spark.createDataFrame([("x",)], "a string")
    for declared in ("int", "date", "boolean", "time"):
        with pytest.raises(Exception):  # noqa: B017
            df.select(coerced(df["a"], df.schema["a"].dataType, declared)).collect()


def test_partitions(spark, tmp_path):
    c = Catalog()
    c.create_server("s")
    for name, text in (("p1", "1,a\n4,b\n"), ("p2", "5,c\n8,d\n")):
        (tmp_path / name).write_text(text)
        c.create_table(name, "s", [("c1", "int"), ("c2", "text")], format="csv", location=f"file://{tmp_path}/{name}")
    assert open_partitions(spark, c, ["p1", "p2"]).count() == 4
    assert open_partitions(spark, c, ["p1", "p2"], {"p1": (1, 4), "p2": (5, 8)}, "c1").count() == 2
