import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    at = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(at / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{at}/shared")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


EMP = """1,ann,clerk,4,2001-02-03,800,,10
2,bob,sales,4,2002-03-04,1250,300,20
3,cy,sales,4,2002-05-06,1250,500,20
4,dee,boss,NULL,1999-01-02,5000,NULL,10
5,eve,clerk,2,2003-07-08,1100,0,30
6,fay,analyst,4,2004-09-10,3000,NULL,NULL
"""
DEPT = "10,books,york\n20,toys,leeds\n30,food,bath\n40,none,hull\n"
EMP_COLUMNS = [("empno", "int"), ("ename", "varchar(10)"), ("job", "varchar(9)"), ("mgr", "int"), ("hiredate", "date"), ("sal", "int"), ("comm", "int"), ("deptno", "int")]
DEPT_COLUMNS = [("deptno", "int"), ("dname", "varchar(14)"), ("loc", "varchar(13)")]


@pytest.fixture(scope="session")
def catalog(spark, tmp_path_factory):
    """emp and dept as delimited text with the word NULL and empty texts, and the same as catalog tables for remote text."""
    from sparkfed.catalog import Catalog
    from sparkfed.sources.readers import open_table

    at = tmp_path_factory.mktemp("tables")
    (at / "emp.txt").write_text(EMP)
    (at / "dept.txt").write_text(DEPT)
    c = Catalog()
    c.create_server("files", client_type="spark")
    for name, columns in (("emp", EMP_COLUMNS), ("dept", DEPT_COLUMNS)):
        c.create_table(name + "_text", "files", columns, format="csv", location=f"file://{at}/{name}.txt")
        open_table(spark, c, name + "_text").write.mode("overwrite").saveAsTable(name)
        c.create_table(name, "files", columns)
    return c
