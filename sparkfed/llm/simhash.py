"""SimHash near-duplicate groups by covering locality-sensitive hashing (Pagh, 2016).

A text's fingerprint has 64 bits; two texts are linked if at most RADIUS bits differ. The bit positions are
labelled with the vectors of GF(2)^(r+1) whose top coordinate is 1; each non-zero vector v gives a mask that keeps
the positions whose label has an odd product with v. The labels of r differing positions span at most r dimensions, so
some v is orthogonal to all of them: its mask hides every difference, and the pair collides in that table. No pair
within the radius is missed. The v with the top coordinate alone is orthogonal to no label and is left out; each of
the other 2^(r+1) - 2 masks keeps exactly half of 64, 32 or 16 positions.

Buckets hold distinct fingerprints only, so copies never meet as pairs. A bucket of more than BUCKET fingerprints is
refined with the same construction over the positions its mask hides (32, then 16, then 8 free bits: the last level
has at most 256 values), so hot buckets cost a factor of 30, not a square. A bucket gives links to its components'
smallest members, at most one for each fingerprint.

keep_first has another bound: a similarity of 0.8 of the sets of shingles. Its candidates are the groups that SimHash
links, found as above and complete, and more: at 0.8 SimHash distances are about ten bits, where no covering is small.
So a text also has several fingerprints of the least shingles under ROWS permutations; texts of similarity s share one
of BANDS with probability 1 - (1 - s^ROWS)^BANDS (0.994 at 0.8). Candidates are compared by their shingles, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, components, materialise

RADIUS = 4
BUCKET = 512
SEED = 42
#: keep_first: the least similarity of near copies, and the fingerprints a text has besides SimHash: BANDS of ROWS minima.
SIMILAR = 0.8
ROWS, BANDS = 7, 22


def masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """The covering masks over the given bit positions."""
    top = 2**radius
    label = {p: top + i % top for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (label[p] & v).bit_count() % 2) for v in range(1, 2 * top) if v != top]


def shingle_hashes(text: str | None, shingle: int):
    """The shingles' XXH64 values, repeats included; none for a text without words."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([hashed(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


def majority(hashes) -> int:
    """The bits that are set in over half the values."""
    import numpy as np

    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory, whole text
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            count += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return sum(1 << i for i, x in enumerate((2 * count > len(hashes)).tolist()) if x)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64 values. No words: zero."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): fp is the fingerprint's bits as a signed long."""
    import pandas as pd

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            fp = [fingerprint(t, shingle) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "fp": pd.array([x - (x >> 63 << 64) for x in fp], dtype="int64")})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, fp long")


def bucket_links(fps: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (member, smallest member) of the components that fingerprints of one bucket form."""
    import numpy as np

    a = np.array(sorted(fps), np.int64)
    near = np.bitwise_count((a[:, None] ^ a[None, :]).view(np.uint64)) <= radius
    root = np.arange(len(a))
    while True:
        low = np.where(near, root[None, :], len(a)).min(axis=1)
        low = low[low]
        if (low == root).all():
            return [(int(a[i]), int(a[r])) for i, r in enumerate(root.tolist()) if i != r]
        root = low


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect exactly those within the radius.

    bucket is at least 2^8, for a radius of 4 then all buckets of the third level fit."""
    import pandas as pd

    out = None
    rows = distinct.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("fixed"))
    for _ in range(3):
        def explode(batches: Iterator) -> Iterator:
            import numpy as np

            known: dict = {}
            for b in batches:
                for (path, fixed), g in b.groupby(["path", "fixed"], sort=False):
                    fixed = int(fixed) & (2**64 - 1)
                    if fixed not in known:
                        if len(known) > 4096:
                            known.clear()
                        free = [i for i in range(64) if not fixed >> i & 1]
                        known[fixed] = [m | fixed for m in masks(free, radius)]
                    fp = g["fp"].to_numpy(np.int64)
                    for t, m in enumerate(known[fixed]):
                        signed = np.int64(m - (m >> 63 << 64))
                        yield pd.DataFrame({"path": f"{path}{t}.", "fixed": signed, "key": fp & signed, "fp": fp})

        def meet(batches: Iterator) -> Iterator:
            """Streams buckets in order; one that outgrows the bound is passed on, row by row, to be refined."""
            now, held, over = None, [], False
            found, passed = [], []

            def close() -> None:
                if not over and len(held) > 1:
                    found.extend(bucket_links(held, radius))

            def flush() -> Iterator:
                nonlocal found, passed
                if found:
                    yield pd.DataFrame({"a": [x for x, _ in found], "b": [y for _, y in found], "path": None, "fixed": 0})
                if passed:
                    yield pd.DataFrame({"a": [x[0] for x in passed], "b": 0, "path": [x[1] for x in passed], "fixed": [x[2] for x in passed]})
                found, passed = [], []

            for b in batches:
                for path, fixed, key, fp in zip(b["path"].tolist(), b["fixed"].tolist(), b["key"].tolist(), b["fp"].tolist()):
                    if (path, key, fixed) != now:
                        close()
                        now, held, over = (path, key, fixed), [], False
                    if over:
                        passed.append((fp, f"{path}{key}.", fixed))
                    else:
                        held.append(fp)
                        if len(held) > bucket:
                            over = True
                            passed.extend((x, f"{path}{key}.", fixed) for x in held)
                            held = []
                yield from flush()
            close()
            yield from flush()

        spread = rows.mapInPandas(explode, "path string, fixed long, key long, fp long")
        met = spread.repartition("path", "key").sortWithinPartitions("path", "fixed", "key", "fp")
        met = materialise(met.mapInPandas(meet, "a long, b long, path string, fixed long"))
        found = met.where("path is null").select("a", "b")
        out = found if out is None else out.union(found)
        rows = met.where("path is not null").select(F.col("a").alias("fp"), "path", "fixed")
        if rows.isEmpty():
            return out.distinct()
    raise RuntimeError("a bucket of at most 256 values cannot overflow")


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = RADIUS, bucket: int = BUCKET, id_col: str = "doc_id") -> DataFrame:
    """Rows (id_col, fp, component_id, n_links): the smallest id reachable over links, and how many other distinct
    fingerprints the row's fingerprint is tied to directly in the link forest.

    Null text counts as empty (fingerprint zero, linked like any other); rows with a null id keep a null component
    unless an id is reachable; repeated rows stay repeated; an empty table gives an empty result; further columns
    of docs are ignored.
    """
    fp = materialise(fingerprints(docs, shingle, id_col))
    distinct = materialise(fp.groupBy("fp").agg(F.min("id").alias("low")))
    tied = materialise(links(distinct.select("fp"), radius, bucket))
    root = components(tied).select(F.col("node").alias("fp"), "root")
    named = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    degree = tied.select(F.col("a").alias("fp")).union(tied.select("b")).groupBy("fp").agg(F.count("*").alias("n_links"))
    of = materialise(named.join(low, "root").join(degree, "fp", "left").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return fp.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "n_links")


def distinct_shingles(hashes):
    """shingle_hashes() once each, sorted; of a text without words the empty sequence's."""
    import numpy as np
    import xxhash

    return np.unique(hashes) if len(hashes) else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def shingles(text: str | None, shingle: int = 5):
    """The distinct XXH64 values of the shingles, sorted; a text of fewer words is one shingle."""
    return distinct_shingles(shingle_hashes(text, shingle))


def similarity(a, b) -> float:
    """The Jaccard similarity of two results of shingles()."""
    import numpy as np

    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def multipliers():
    import numpy as np

    return np.random.default_rng(SEED).integers(0, 2**63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(own, odd) -> list[int]:
    """A signed 64-bit key for each band: of the least of the shingles' values under each of ROWS permutations."""
    import numpy as np
    import xxhash

    least = np.full(len(odd), 2**64 - 1, np.uint64)
    for at in range(0, len(own), 1024):  # bounded memory, whole text
        np.minimum(least, (own[at : at + 1024, None] * odd).min(axis=0), out=least)
    keys = (xxhash.xxh64_intdigest(least[i : i + ROWS].tobytes(), i) for i in range(0, len(odd), ROWS))
    return [x - (x >> 63 << 64) for x in keys]


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows (id, text, node, n, fp, keys): node is a digest of the set of shingles, n its size, fp the SimHash."""
    import pandas as pd

    def run(batches: Iterator) -> Iterator:
        import xxhash

        odd = multipliers()
        for b in batches:
            for i in range(0, len(b), 1000):
                part = b.iloc[i : i + 1000]
                every = [shingle_hashes(t, shingle) for t in part["text"]]
                fp = pd.array([x - (x >> 63 << 64) for x in map(majority, every)], dtype="int64")
                sets = [distinct_shingles(h) for h in every]
                keys = pd.Series([band_keys(s, odd) for s in sets], index=part.index, dtype=object)
                yield part.assign(node=[xxhash.xxh3_128_digest(s.tobytes()) for s in sets], n=[len(s) for s in sets], fp=fp, keys=keys)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id").alias("id"), "text").mapInPandas(run, f"id {kind}, text string, node binary, n long, fp long, keys array<long>")


def similar(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose shingles' exact similarity is `least` or more."""
    import pandas as pd

    def run(batches: Iterator) -> Iterator:
        last, own = None, None
        for batch in batches:
            hit = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"]):
                if b != last:
                    last, own = b, shingles(y, shingle)
                hit.append(similarity(shingles(x, shingle), own) >= least)
            yield pd.DataFrame({"a": batch["a"][hit], "b": batch["b"][hit]})

    of = lambda node, text: texts.select(F.col("node").alias(node), F.col("text").alias(text))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").sortWithinPartitions("b")
    return both.select("a", "b", "x", "y").mapInPandas(run, "a binary, b binary")


def similar_groups(docs: DataFrame, shingle: int = 5, least: float = SIMILAR) -> DataFrame:
    """Rows (id, component_id): the smallest id reachable over pairs of texts of similarity `least` or more.

    Pairs are candidates if their SimHash fingerprints are linked within RADIUS bits, as in near_groups, or if they meet
    in a band of least shingles. A group of linked fingerprints is a bucket like those of the bands. Of each bucket all members are first compared with its smallest one;
    then all pairs of members that are still in different components are compared, unless their sizes rule it out. So
    copies of one text never meet as pairs, and no pair of a bucket that matters is left out."""
    rows = materialise(sketches(docs, shingle))
    distinct = materialise(rows.groupBy("node").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    prints = materialise(rows.select("node", "n", "fp").distinct())  # repeats count: texts of one set can differ in fp
    tied = materialise(links(prints.select("fp").distinct()))
    grouped = prints.join(components(tied).withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.select("node", "n", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key")).distinct()
    bands = distinct.select("node", "n", F.explode("keys").alias("key")).union(grouped)
    shared = bands.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "b")
    bands = materialise(bands.join(shared, "key"))
    texts = materialise(rows.join(bands.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")))
    near = materialise(bands.where("node <> b").select(F.col("node").alias("a"), "b").distinct())
    found = materialise(similar(near, texts, shingle, least))
    root = components(found).select("node", "root")
    placed = bands.join(root, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    open_ = placed.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("key")
    placed = materialise(placed.join(open_, "key"))
    x, y = placed.alias("x"), placed.alias("y")
    fits = (F.col("x.root") < F.col("y.root")) & (F.least("x.n", "y.n") >= least * F.greatest("x.n", "y.n"))
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & fits).select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
    rest = materialise(rest.join(near, ["a", "b"], "left_anti"))
    found = found.union(materialise(similar(rest, texts, shingle, least)))
    root = components(found)
    named = distinct.select("node", "low").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.select("id", "node").join(named.join(low, "root").select("node", "component_id"), "node").select("id", "component_id")


def keep_first(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """docs without those in a group of texts of similarity SIMILAR or more whose smallest id is another row's. Columns
    stay as they are. Rows with a null id and repeated rows of a group's smallest id stay."""
    groups = similar_groups(docs.select("doc_id", "text"), shingle)
    gone = groups.where("component_id <> id").select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*docs.columns)


by_value(__name__)
