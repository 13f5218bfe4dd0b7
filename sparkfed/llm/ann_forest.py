"""Approximate nearest neighbours by hash-prefix forests (LSH Forest).

Every tree gives a vector a long string of hash bits: its sides of random hyperplanes through the centre of a bounded
sample. A tree is the sorted array of all strings. A query descends in each tree to the entries that share the longest
prefix with it; ascending, shorter prefixes match more. All trees ascend together, one prefix length at a time and STEP
trees at once; what a step newly matches is compared exactly, in double precision.

When to stop follows from the query itself. Two vectors at angle a share a bit with probability 1 - a / pi, so how
likely the trees, ascended as far as they are, miss an entry at that angle is known. The ascent ends when the k nearest
found would be missed with a mean probability of at most 1 - RECALL: the true k nearest are as near or nearer. So a
query in a dense cluster compares little, one among evenly spread vectors much, and at prefix length 0 all.

Vectors are dealt by a hash of their id into blocks of about BLOCK, and each block has a forest of its own, so a forest
fits a task whatever the table's size. The stated queries meet every block, batch by batch behind the block's vectors
in one sorted stream; only their nearest of each block leave it. Equal vectors are one entry, which stands for their
smallest ids; so a vector that a third of all rows hold is no larger than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, materialise, rows_per

TREES, BITS, STEP, BLOCK, RECALL, SAMPLE = 256, 24, 32, 8192, 0.95, 4096


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): rows with an id and a vector of finite numbers, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vec_col)
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(~F.exists(v, bad) & F.exists(v, lambda x: x != 0))
    return rows.select(F.col(id_col).alias("id"), v.alias("v"))


def planes(classes: DataFrame, dim: int, sample: int, trees: int, bits: int, seed: int):
    """The sample's mean, and hyperplanes' normals: (dim) and (dim, trees * bits)."""
    import numpy as np

    got = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").toPandas()["v"]
    centre = np.mean([np.asarray(x, np.float64) for x in got], axis=0) if len(got) else np.zeros(dim)
    return centre, np.random.default_rng(seed).standard_normal((dim, trees * bits))


class Forest:
    """Sorted arrays of the block's strings, one for each tree."""

    def __init__(self, x, normals, centre, trees: int):
        import numpy as np

        self.x, self.normals, self.centre, self.trees = x, normals, centre, trees
        self.norms = np.sqrt(((x - centre) ** 2).sum(axis=1))
        strings = self.strings(x)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, x):
        """(trees, rows)"""
        import numpy as np

        out = np.zeros((len(x), self.trees), np.int32)
        for i in range(0, len(x), 1024):
            sides = (x[i : i + 1024] - self.centre) @ self.normals > 0
            for bit in range(BITS):
                out[i : i + 1024] |= sides[:, bit::BITS].astype(np.int32) << (BITS - 1 - bit)
        return np.ascontiguousarray(out.T)

    def nearest(self, queries, k: int, recall: float):
        """(entry, distance, compared): each query's k + 1 nearest entries found, in order, ties to the earlier entry,
        -1 where there are fewer; and with how many entries it was compared."""
        import numpy as np

        n, m = len(self.x), len(queries)
        own = self.strings(queries)
        norms = np.sqrt(((queries - self.centre) ** 2).sum(axis=1))
        found, compared = np.zeros(m * n, bool), np.zeros(m, np.int64)
        entry, far = np.full((m, k + 1), -1, np.int64), np.full((m, k + 1), np.inf)
        lo, hi = np.zeros((self.trees, m), np.int64), np.zeros((self.trees, m), np.int64)
        level = np.full(self.trees, BITS + 1)
        open_ = np.arange(m)
        for length in range(BITS, -1, -1):  # synchronous ascent
            for first in range(0, self.trees, STEP):
                keys = []
                for t in range(first, min(first + STEP, self.trees)):
                    low = own[t, open_] >> (BITS - length) << (BITS - length)
                    start = np.searchsorted(self.sorted[t], low, side="left")
                    end = np.searchsorted(self.sorted[t], low + ((1 << (BITS - length)) - 1), side="right")
                    fresh = level[t] > BITS
                    was_lo, was_hi = (start, start) if fresh else (lo[t, open_], hi[t, open_])
                    for at, to in ((start, was_lo), (was_hi, end)):
                        size = to - at
                        places = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
                        keys.append(np.repeat(open_, size) * n + self.order[t, places])
                    lo[t, open_], hi[t, open_], level[t] = start, end, length
                new = np.concatenate(keys)
                new = np.unique(new[~found[new]])
                found[new] = True
                self.compare(queries, new, entry, far, compared)
                if recall < 1:
                    open_ = open_[self.missed(far[open_], entry[open_], norms[open_], level, k) > 1 - recall]
                if not len(open_):
                    return entry, far, compared
        return entry, far, compared

    def compare(self, queries, new, entry, far, compared):
        """Takes pairs (query * entries + entry) into the nearest found."""
        import numpy as np

        n, width = len(self.x), far.shape[1]
        for i in range(0, len(new), 65536):
            q, e = np.divmod(new[i : i + 65536], n)
            d = np.sqrt(((self.x[e] - queries[q]) ** 2).sum(axis=1))
            compared += np.bincount(q, minlength=len(compared))
            near = d <= far[q, -1]
            q, e, d = q[near], e[near], d[near]
            if not len(q):
                continue
            who = np.unique(q)
            q, e, d = (np.concatenate(z) for z in ((np.repeat(who, width), q), (entry[who].ravel(), e), (far[who].ravel(), d)))
            order = np.lexsort((e, d, q))
            q, e, d = q[order], e[order], d[order]
            first = np.searchsorted(q, who, side="left")
            at = first[:, None] + np.arange(width)
            entry[who], far[who] = e[at], d[at]

    def missed(self, far, entry, norms, level, k: int):
        """For each query the mean probability that the trees, each ascended to its level, miss one of the k nearest
        entries found (not counting those equal to the query); 1 for each that is lacking."""
        import numpy as np

        other = self.norms[entry]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = (norms[:, None] ** 2 + other**2 - far**2) / (2 * norms[:, None] * other)
        p = 1 - np.arccos(np.clip(np.nan_to_num(cosine, nan=0.0, posinf=0.0, neginf=0.0), -1, 1)) / np.pi
        miss = np.ones_like(far)
        for length, trees in zip(*np.unique(level, return_counts=True)):
            if length <= BITS:
                miss *= (1 - p**length) ** trees
        miss[entry < 0] = 1
        equal = far[:, 0] == 0
        return np.where(equal, miss[:, 1:].sum(axis=1), miss[:, :k].sum(axis=1)) / k


def nearest(
    vectors: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    trees: int = TREES, block: int = BLOCK, recall: float = RECALL, sample: int = SAMPLE, seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by Euclidean distance for each row that `queries`, a
    condition on id, names; all of the others if there are fewer. Ties go to the smaller id. With a recall of 1 all are compared.

    Rows with a null id and vectors that are null, zero or hold null or non-finite components take no part, nor do
    those whose length is not the commonest. Ids are taken to be unique; of repeated rows each takes part. An empty
    table gives no rows; further columns are ignored."""
    import numpy as np
    import pandas as pd

    rows = usable(vectors, id_col, vec_col)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    dim = sizes["n"] if sizes else 1
    rows = rows.where(F.size("v") == dim)
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    classes = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = materialise(classes.select(F.col("ids")[0].alias("rep"), "v", "ids"))
    asked = materialise(rows.where(queries).join(classes.select("v", "rep"), "v").select(F.col("id").alias("query_id"), "rep"))
    centre, normals = planes(classes, dim, sample, trees, BITS, seed)

    kind = rows.schema["id"].dataType.simpleString()
    blocks = rows_per(classes, block)
    held = classes.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"), "rep", "v", "ids")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asks = classes.join(asked.select("rep").distinct(), "rep", "left_semi").select(every, F.lit(1).alias("asks"), "rep", "v", F.lit(None).cast(f"array<{kind}>").alias("ids"))
    stream = held.unionByName(asks).repartition("block").sortWithinPartitions("block", "asks")

    def search(batches: Iterator) -> Iterator:
        now, parts, forest, ids = None, [], None, None
        for b in batches:
            for (blk, asking), g in b.groupby(["block", "asks"], sort=True):
                if blk != now:
                    now, parts, forest = blk, [], None
                if not asking:
                    parts.append(g)
                    continue
                if not parts and forest is None:
                    continue  # a block without vectors
                if forest is None:
                    whole = pd.concat(parts).sort_values("rep")  # ties go to the earlier entry
                    ids = whole["ids"].tolist()
                    forest = Forest(np.stack(whole["v"].to_numpy()).astype(np.float64), normals, centre, trees)
                    parts = []
                for i in range(0, len(g), 256):
                    part = g.iloc[i : i + 256]
                    q = np.stack(part["v"].to_numpy()).astype(np.float64)
                    query, out, score = [], [], []
                    entries, distances, _ = forest.nearest(q, k, recall)
                    for rep, at, far in zip(part["rep"].tolist(), entries.tolist(), distances.tolist()):
                        near = sorted((d, m) for j, d in zip(at, far) if j >= 0 for m in ids[j])
                        for d, m in near[: k + 1]:
                            query.append(rep)
                            out.append(m)
                            score.append(d)
                    yield pd.DataFrame({"query": query, "id": out, "score": score})

    far = stream.mapInPandas(search, f"query {kind}, id {kind}, score double")
    order = Window.partitionBy("query").orderBy("score", "id")
    near = far.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    own = near.join(asked.withColumnRenamed("rep", "query"), "query").where("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return own.select("query_id", rank.cast("int").alias("rank"), F.col("id").alias("vec_id"), "score").where(F.col("rank") <= k)


by_value(__name__)
