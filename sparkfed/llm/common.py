"""Shared pieces of the training-data operators: tables, cut lineage, components."""

from __future__ import annotations

import atexit
import re
import sys
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_state: dict = {}
#: Paths that materialise() has made within the innermost settled().
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
#: Whether Spark removes a query's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that Spark hands to a Python worker at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def by_value(name: str) -> None:
    """Ship a module's functions inside the task, so executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker does, whatever task runs in it; other operators' are emptied."""
    import sys
    import types

    kept = sys.modules.setdefault("_sparkfed_worker_cache", types.ModuleType("_sparkfed_worker_cache")).__dict__
    for k, v in kept.items():
        if k != name and isinstance(v, dict) and not k.startswith("__"):
            v.clear()
    return kept.setdefault(name, {})


def give_back() -> None:
    """Returns freed memory to the system: large arrays of one chunk would else stay with the worker."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Generations(dict):
    """A cache of bounded size: what is asked for moves to the young half, and the old half is dropped when that is full."""

    def __init__(self, half: int):
        super().__init__()
        self.half, self.old = half, {}

    def __missing__(self, key: object) -> object:
        v = self[key] = self.old[key]
        return v

    def lacks(self, keys: set) -> list:
        """The keys that neither half holds; before that, makes room."""
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()
        old = self.old
        return [k for k in keys if k not in self and k not in old]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session gets one of
    its own; on a cluster that is an error, since machines do not see each other's folders."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = _state.setdefault("dir", None) or "file://" + tempfile.mkdtemp(prefix="sparkfed-")
        _state["dir"] = at
    return at.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone; the shared folder's owner clears it
        pass


def materialise(df: DataFrame, batch: int | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, and a lost executor loses nothing.

    The write's shuffle files go as soon as it is done. The result's own files stay until free(), the end of a settled()
    call or the end of the process. batch: rows that a Python worker gets at once, where they are whole texts."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sparkfed/{uuid.uuid4().hex}"
    own = {CLEAN_UP: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    atexit.register(_drop, spark, path)
    made = _made.get()
    if made is not None:
        made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sparkfed_path = path
    return out


def free(*found: DataFrame) -> None:
    """Removes the files of materialise()'s results, once all that reads them has been written."""
    for df in found:
        _drop(df.sparkSession, df._sparkfed_path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The result of make(), materialised; all else that was materialised on the way is removed."""
    made: list[str] = []
    token = _made.set(made)
    try:
        out = materialise(make())
    finally:
        _made.reset(token)
    for path in made:
        if path != out._sparkfed_path:
            _drop(out.sparkSession, path)
    outer = _made.get()
    if outer is not None:
        outer.append(out._sparkfed_path)
    return out


def rows_per(df: DataFrame, n_rows: int) -> int:
    """A number of salts or blocks that keeps about n_rows rows in each, at any size."""
    return max(1, -(-df.count() // n_rows))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root) with root the smallest node of the component.

    Alternating large-star and small-star rounds, which need about log(longest path) rounds; every round is
    written to the shared folder. Nodes of high degree are safe: minima are partially aggregated, and the
    joins are plain sort-merge joins, which adaptive execution splits where a key is hot.
    Null ends are ignored; a self loop gives a component of its own.
    """
    e = edges.where("a is not null and b is not null")
    loops = e.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    e = e.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e)
    before = None
    for _ in range(rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(low.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        last, e = e, materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        free(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.union(roots).union(loops).groupBy("node").agg(F.min("root").alias("root"))


by_value(__name__)
