"""Repeated passages by a hash-compared suffix sort.

A byte goes if a string of LENGTH bytes that covers it also starts earlier: in a row of smaller doc_id, or before it in
the same text. Strings do not cross texts, and are judged on the input.

Suffix sort: prefix polynomial hashes give the hash of any substring in constant time, and a binary search over lengths
the longest common extension of two suffixes; so a comparison takes logarithmic time, in a merge sort whose steps run
over all suffixes at once. Suffixes of which LENGTH bytes agree come out side by side, and are verified byte by byte;
should a hash have lied, the group is sorted by its bytes.

Which suffixes meet: each string of LENGTH bytes has an anchor, its Q-gram of the smallest hash, and equal strings have
equal anchors at equal places in them. Strings in a row that share an anchor are a run; of about 35 bytes of text there
is one run. Texts are packed into units of about CHUNK bytes; a longer text is several units, which overlap by LENGTH - 1
bytes, so that each of its strings starts in one of them:

1.  Units emit the hashes of their anchors, each once. Those that two units hold go back to them.
2.  Units sort the suffixes of runs whose anchor occurs again, here or elsewhere. Of equal runs, then of equal strings
    at the same place to the anchor, all but the earliest are marked. The earliest runs whose anchor others hold are
    emitted with their bytes, once per unit whatever the number of copies in it.
3.  Buckets of anchors sort those in the same way, and send marks back to the units, which cut.

An anchor that more than HOT units hold would fill its bucket. Its runs are rows of their own instead, and meet by their
whole content: minima that are aggregated before they are shuffled, first of runs, then of the strings of those anchors
of which several different runs are left. So no task holds all that shares a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, free, give_back, materialise, worker_cache

LENGTH, Q, CHUNK = 100, 32, 800_000
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes of text for which there is one bucket of anchors.
BUCKET = 4_000_000
#: Units with the same anchor that one bucket takes; of more, runs meet by content.
HOT = 1024
MIX = 0xD6E8FEB86659FD93


def mixed(x):
    """Spreads a polynomial hash, whose low bits know little, over all bits."""
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(MIX)
    x ^= x >> np.uint64(29)
    return x


def prefix_hashes(data):
    """P with P[i + 1] = P[i] * BASE + byte + 1, modulo 2^64; computed in blocks by scaled running sums."""
    import numpy as np

    block = 1 << 15
    inverse = np.uint64(pow(BASE, -1, 2**64))
    up = np.cumprod(np.full(block, np.uint64(BASE)), dtype=np.uint64)
    down = np.cumprod(np.full(block, inverse), dtype=np.uint64)
    out = np.zeros(len(data) + 1, np.uint64)
    carry = np.uint64(0)
    for i in range(0, len(data), block):
        c = data[i : i + block].astype(np.uint64) + np.uint64(1)
        own = np.cumsum(c * down[: len(c)], dtype=np.uint64) * up[: len(c)]
        out[i + 1 : i + 1 + len(c)] = own + carry * up[: len(c)]
        carry = out[i + len(c)]
    return out


class Suffixes:
    """Sorts suffixes of data within groups, by as many bytes as each group says."""

    def __init__(self, data, most: int):
        import numpy as np

        self.data, self.prefix = data, prefix_hashes(data)
        self.power = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(most, np.uint64(BASE)), dtype=np.uint64)))

    def hash(self, at, size):
        return self.prefix[at + size] - self.prefix[at] * self.power[size]

    def compare(self, a, b, size):
        """-1, 0 or 1 for each pair of suffixes, by their first `size` bytes."""
        import numpy as np

        out = np.zeros(len(a), np.int8)
        i = np.nonzero(self.hash(a, size) != self.hash(b, size))[0]
        if len(i):
            a, b, lo, hi = a[i], b[i], np.zeros(len(i), np.int64), size[i] - 1
            while (lo < hi).any():  # the longest common extension
                mid = (lo + hi + 1) >> 1
                same = self.hash(a, mid) == self.hash(b, mid)
                lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
            x, y = self.data[a + lo], self.data[b + lo]
            out[i] = np.where(x < y, -1, 1)
        return out

    def sort(self, starts, sizes, groups):
        """Orders suffixes by group, then by content, then as given: (order, first), where first[k] is the place in
        `order` of the first suffix of which the k-th of `order` is a repetition. Sizes are equal within a group."""
        import numpy as np

        order = np.argsort(groups, kind="stable")
        g = groups[order]
        new = np.concatenate(([True], g[1:] != g[:-1]))
        begin = np.nonzero(new)[0]
        count = np.diff(np.append(begin, len(g)))
        of = np.cumsum(new) - 1
        base, n = begin[of], count[of]  # of each place: where its group begins, and the group's size
        width = 1
        place = np.arange(len(order))
        while len(count) and width < count.max():
            live = np.nonzero(n > width)[0]
            rel = live - base[live]
            pair = base[live] + rel // (2 * width) * (2 * width)
            end = base[live] + n[live]
            left = rel % (2 * width) < width
            lo = np.minimum(np.where(left, pair + width, pair), end)  # the other run of the pair
            hi = np.minimum(np.where(left, pair + 2 * width, pair + width), end)
            first, mine = lo.copy(), starts[order[live]]
            size = sizes[order[live]]
            todo = np.nonzero(lo < hi)[0]
            while len(todo):  # how many of the other run come before: smaller ones, for the right run equal ones too
                mid = (lo[todo] + hi[todo]) >> 1
                c = self.compare(starts[order[mid]], mine[todo], size[todo])
                before = (c < 0) | ((c == 0) & ~left[todo])
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            target = np.where(left, live, pair + (rel % (2 * width) - width)) + (lo - first)
            moved = order.copy()
            moved[target] = order[live]
            order = moved
            width *= 2
        same = np.zeros(len(order), bool)
        i = np.nonzero(~new)[0]
        if len(i):
            a, b, size = starts[order[i]], starts[order[i - 1]], sizes[order[i]]
            same[i] = self.hash(a, size) == self.hash(b, size)
        same = self.verified(starts, sizes, order, same, base, n)
        return order, np.maximum.accumulate(np.where(same, 0, place))

    def verified(self, starts, sizes, order, same, base, n):
        """`same` if the bytes agree with it; else groups with a collision are put in order by their bytes."""
        import numpy as np

        i = np.nonzero(same)[0]
        wrong = []
        for at in range(0, len(i), 20_000):
            part = i[at : at + 20_000]
            size = sizes[order[part]]
            for s in np.unique(size).tolist():
                k = part[size == s]
                span = np.arange(s)
                differ = (self.data[starts[order[k]][:, None] + span] != self.data[starts[order[k - 1]][:, None] + span]).any(axis=1)
                wrong += k[differ].tolist()
        for b, m in {(int(base[k]), int(n[k])) for k in wrong}:
            content = lambda j: bytes(self.data[starts[j] : starts[j] + sizes[j]])
            order[b : b + m] = sorted(sorted(order[b : b + m].tolist()), key=content)
            for k in range(b + 1, b + m):
                same[k] = content(order[k]) == content(order[k - 1])
        return same


def runs(suffixes: Suffixes, ends, length: int, q: int):
    """(anchor hash, anchor, first string, last string) of each run; ends: of the texts, one after another, in data."""
    import numpy as np

    n = len(suffixes.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none, none, none
    at = np.arange(n - q + 1)
    grams = mixed(suffixes.hash(at, q))
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, want = 1, length - q + 1
    while 2 * width <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < want:
        low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(len(anchor) + 1, np.int32)
    has = ends - starts >= length
    np.add.at(inside, starts[has], 1)
    np.add.at(inside, ends[has] - length + 1, -1)
    good = np.nonzero(np.cumsum(inside[:-1]) > 0)[0]
    if not len(good):
        return none.astype(np.uint64), none, none, none
    a = anchor[good]
    cut = np.nonzero((a[1:] != a[:-1]) | (good[1:] != good[:-1] + 1))[0] + 1
    first, last = good[np.concatenate(([0], cut))], good[np.concatenate((cut - 1, [len(good) - 1]))]
    a = a[np.concatenate(([0], cut))]
    return grams[a], a, first, last


def repeats(suffixes: Suffixes, key, anchor, first, last, length: int):
    """(places of runs all of whose strings repeat earlier ones, strings of other runs that do), in the given order."""
    import numpy as np

    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = last - first + 1
    shape = mixed(key ^ mixed(((anchor - first) * 512 + count).astype(np.uint64)))
    order, head = suffixes.sort(first, count + length - 1, shape)
    again = order[head != np.arange(len(order))]
    rest = np.ones(len(key), bool)
    rest[again] = False
    rest = np.nonzero(rest)[0]
    _, where, n = np.unique(key[rest], return_inverse=True, return_counts=True)
    rest = rest[n[where] > 1]  # anchors that different runs share
    if not len(rest):
        return again, np.zeros(0, np.int64)
    c = count[rest]
    of = np.repeat(rest, c)
    at = np.repeat(first[rest] - (np.cumsum(c) - c), c) + np.arange(c.sum())
    spot = mixed(key[of] ^ mixed((anchor[of] - at).astype(np.uint64)))
    _, where, n = np.unique(spot, return_inverse=True, return_counts=True)
    some = n[where] > 1
    at, spot = at[some], spot[some]
    order, head = suffixes.sort(at, np.full(len(at), length), spot)
    return again, at[order[head != np.arange(len(order))]]


def segments(sizes, chunk: int, length: int) -> list[tuple[int, int]]:
    """(start, end) of the units of a chunk of whole texts: the chunk itself, or pieces of its one long text."""
    total = int(sizes.sum())
    if len(sizes) != 1 or total <= 2 * chunk:
        return [(0, total)]
    return [(at, min(at + chunk + length - 1, total)) for at in range(0, total - length + 1, chunk)]


def pack_chunks(docs: DataFrame, id_col: str, text_col: str, chunk: int, length: int) -> DataFrame:
    """Chunks of whole texts, in order of id within each: ids, sizes, the texts' bytes, and the other columns. Numbers
    leave room for the units of each chunk."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import zstandard
        from pyspark import TaskContext

        zip_ = zstandard.ZstdCompressor(level=1).compress
        number = TaskContext.get().partitionId() << 33
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            whole = pa.Table.from_batches(held)
            ids = whole.column(id_col).cast(pa.int64()).fill_null(-(2**63)).to_numpy()
            whole = whole.take(np.argsort(ids, kind="stable"))
            texts = [x or b"" for x in whole.column(text_col).cast(pa.binary()).to_pylist()]
            rest = whole.drop_columns([text_col])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as w:
                w.write_table(rest)
            sizes = np.array([len(x) for x in texts], np.int64)
            row = [number, int(sizes.sum()), np.sort(ids, kind="stable").tobytes(), sizes.tobytes(), zip_(b"".join(texts)), zip_(sink.getvalue().to_pybytes())]
            number, held, size = number + len(segments(sizes, chunk, length)), [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["chunk", "n", "ids", "sizes", "text", "rest"])

        for b in batches:
            at = 0
            for i, x in enumerate(b.column(text_col).cast(pa.binary())):
                n = 0 if x.as_buffer() is None else x.as_buffer().size
                long = n > 2 * chunk
                if long and (held or i > at):  # a long text is a chunk of its own
                    held += [b.slice(at, i - at)] * (i > at)
                    at = i
                    yield flush()
                size += n
                if long or size >= chunk:
                    held.append(b.slice(at, i + 1 - at))
                    at = i + 1
                    yield flush()
            if at < b.num_rows:
                held.append(b.slice(at))
        if held:
            yield flush()

    return docs.mapInArrow(run, "chunk long, n long, ids binary, sizes binary, text binary, rest binary")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, q: int = Q, chunk: int = CHUNK, bucket: int = BUCKET, hot: int = HOT, whole_characters: bool = False) -> DataFrame:
    """docs without the text, with n_bytes, spans (start and end of each maximal removed run, in bytes) and kept, the
    bytes that remain. whole_characters: a character of which a byte stays keeps the others too.

    Ids are whole numbers; a null id comes before all others. Null text counts as empty; texts under `length` bytes
    keep all; a very long text is sorted in pieces. Of rows that share an id, which one is earlier is fixed but
    arbitrary. An empty table gives no rows; columns named like the results are replaced."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    from pyspark.sql import types as T

    most = 2 * length
    docs = docs.select(*(c for c in docs.columns if c not in ("n_bytes", "spans", "kept")))
    chunks = materialise(pack_chunks(docs, id_col, text_col, chunk, length))
    parts = max(1, -(-(chunks.agg(F.sum("n")).first()[0] or 0) // bucket))

    def deal(key):
        return ((key >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)

    def units(row) -> Iterator:
        """(number, start, sorter, ends of texts) of each unit of a chunk, one at a time."""
        import zstandard

        text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
        sizes = np.frombuffer(row["sizes"], np.int64)
        cuts = segments(sizes, chunk, length)
        for i, (lo, hi) in enumerate(cuts):
            give_back()
            yield row["chunk"] + i, lo, Suffixes(text[lo:hi], most), np.cumsum(sizes) if len(cuts) == 1 else np.array([hi - lo])

    def anchors(batches: Iterator) -> Iterator:
        for b in batches:
            worker_cache("suffix")
            for row in b.to_dict("records"):
                for unit, _, s, ends in units(row):
                    key = np.unique(runs(s, ends, length, q)[0])
                    del s
                    to = deal(key)
                    order = np.argsort(to, kind="stable")
                    cuts = np.append(np.nonzero(np.diff(to[order], prepend=-1))[0], len(order))
                    rows = [(int(to[order[i]]), row["chunk"], unit, key[order[i:j]].tobytes()) for i, j in zip(cuts, cuts[1:])]
                    yield pd.DataFrame(rows, columns=["part", "chunk", "unit", "keys"])

    def shared(group: pd.DataFrame) -> pd.DataFrame:
        """To each unit, its anchors that another unit has, and those that more than `hot` have."""
        keys = [np.frombuffer(x, np.uint64) for x in group["keys"]]
        u, n = np.unique(np.concatenate(keys), return_counts=True)
        many = u[n > hot]
        u = u[(n > 1) & (n <= hot)]
        rows = []
        for c, unit, k in zip(group["chunk"], group["unit"], keys):
            some, more = k[np.isin(k, u, assume_unique=True)], k[np.isin(k, many, assume_unique=True)]
            if len(some) or len(more):
                rows.append((c, unit, some.tobytes(), more.tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "unit", "keys", "hot"])

    emitted = chunks.select("chunk", "sizes", "text").mapInPandas(anchors, "part long, chunk long, unit long, keys binary")
    back = emitted.groupBy("part").applyInPandas(shared, "chunk long, unit long, keys binary, hot binary")
    back = back.groupBy("chunk").agg(F.collect_list(F.struct("unit", "keys", "hot")).alias("back"))

    #: part -1: marks of the unit itself; -2: runs of hot anchors, by themselves.
    fields = "part long, chunk long, meta binary, bytes binary"

    def local(batches: Iterator) -> Iterator:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            worker_cache("suffix")
            for row in b.to_dict("records"):
                ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
                stops = np.cumsum(sizes)
                asked = {}
                for x in row["back"] if row["back"] is not None else ():
                    asked.setdefault(x["unit"], []).append(x)
                for unit, lo, s, ends in units(row):
                    key, anchor, first, last = runs(s, ends, length, q)
                    some = np.concatenate([key[:0], *(np.frombuffer(x["keys"], np.uint64) for x in asked.get(unit, ()))])
                    many = np.concatenate([key[:0], *(np.frombuffer(x["hot"], np.uint64) for x in asked.get(unit, ()))])
                    _, where, n = np.unique(key, return_inverse=True, return_counts=True)
                    own = np.nonzero(n[where] > 1)[0] if len(key) else np.zeros(0, np.int64)
                    again, single = repeats(s, key[own], anchor[own], first[own], last[own], length)
                    again = own[again]
                    marks = np.concatenate((np.stack((first[again], last[again] - first[again] + 1), 1), np.stack((single, np.ones_like(single)), 1)))
                    marks[:, 0] += lo
                    rows = [(-1, row["chunk"], marks.astype(np.int64).tobytes(), b"")]
                    to = np.where(np.isin(key, many), -2, np.where(np.isin(key, some), deal(key), -1))
                    to[again] = -1
                    go = np.nonzero(to != -1)[0]
                    if len(go):
                        go = go[np.argsort(to[go], kind="stable")]
                        place = first[go] + lo
                        doc = np.searchsorted(stops, place, side="right")
                        meta = np.stack((key[go].view(np.int64), ids[doc], place - (stops - sizes)[doc], place, anchor[go] - first[go], last[go] - first[go] + 1), 1)
                        cuts = np.append(np.nonzero(np.diff(to[go], prepend=-3))[0], len(go))
                        for i, j in zip(cuts, cuts[1:]):
                            size = meta[i:j, 5] + length - 1
                            at = np.repeat(first[go[i:j]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                            rows.append((int(to[go[i]]), row["chunk"], zip_(meta[i:j].tobytes()), zip_(s.data[at].tobytes())))
                    del s
                    yield pd.DataFrame(rows, columns=["part", "chunk", "meta", "bytes"])

    sorted_ = materialise(chunks.select("chunk", "ids", "sizes", "text").join(back.hint("merge"), "chunk", "left").mapInPandas(local, fields))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        give_back()
        unzip = zstandard.ZstdDecompressor().decompress
        metas = [np.frombuffer(unzip(x), np.int64).reshape(-1, 6) for x in group["meta"]]
        data = np.frombuffer(b"".join(unzip(x) for x in group["bytes"]), np.uint8)
        chunk_of = np.repeat(group["chunk"].to_numpy(), [len(m) for m in metas])
        meta = np.concatenate(metas)
        size = meta[:, 5] + length - 1
        begin = np.cumsum(size) - size
        order = np.lexsort((meta[:, 3], chunk_of, meta[:, 2], meta[:, 1]))  # earliest first
        s = Suffixes(data, most)
        first = begin[order]
        again, single = repeats(s, np.ascontiguousarray(meta[order, 0]).view(np.uint64), first + meta[order, 4], first, first + meta[order, 5] - 1, length)
        again = order[again]
        of = np.searchsorted(begin, single, side="right") - 1
        chunk_ = np.concatenate((chunk_of[again], chunk_of[of]))
        at = np.concatenate((meta[again, 3], meta[of, 3] + single - begin[of]))
        count = np.concatenate((meta[again, 5], np.ones_like(single)))
        o = np.argsort(chunk_, kind="stable")
        cuts = np.append(np.nonzero(np.diff(chunk_[o], prepend=-1))[0], len(o))
        rows = [(int(chunk_[o[i]]), np.stack((at[o[i:j]], count[o[i:j]]), 1).tobytes()) for i, j in zip(cuts, cuts[1:])]
        return pd.DataFrame(rows, columns=["chunk", "marks"])

    def opened(batches: Iterator) -> Iterator:
        """A row for each run of a hot anchor."""
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for c, m, x in zip(b["chunk"], b["meta"], b["bytes"]):
                meta, data = np.frombuffer(unzip(m), np.int64).reshape(-1, 6), unzip(x)
                stop = np.cumsum(meta[:, 5] + length - 1).tolist()
                out = pd.DataFrame(meta, columns=["key", "id", "off", "at", "anchor", "count"])
                yield out.assign(chunk=c, bytes=[data[i:j] for i, j in zip([0, *stop], stop)])

    marks = sorted_.where("part >= 0").groupBy("part").applyInPandas(meet, "chunk long, marks binary")
    marks = sorted_.where("part = -1").select("chunk", F.col("meta").alias("marks")).union(marks)
    marks = materialise(marks.groupBy("chunk").agg(F.collect_list("marks").alias("marks")))
    held = materialise(sorted_.where("part = -2").mapInPandas(opened, "key long, id long, off long, at long, anchor long, count long, chunk long, bytes binary"))
    free(sorted_)
    if held.isEmpty():
        marks = marks.withColumn("hot", F.lit(None).cast("array<struct<at:bigint,count:bigint>>"))
    else:
        marks = marks.join(materialise(hot_marks(held, length)).hint("merge"), "chunk", "full")
    free(held)

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kept_fields = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*kept_fields, T.StructField("n_bytes", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator) -> Iterator:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            for row in b.to_pylist():
                give_back()
                text = np.frombuffer(unzip(row["text"]), np.uint8)
                sizes = np.frombuffer(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                marks = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in row["marks"] or []]
                marks.append(np.array([(x["at"], x["count"]) for x in row["hot"] or []], np.int64).reshape(-1, 2))
                marks = np.concatenate(marks)
                # Spans of strings in a row: their union, by sorted starts.
                marks = marks[np.argsort(marks[:, 0], kind="stable")]
                stop = np.maximum.accumulate(marks[:, 0] + marks[:, 1] - 1 + length) if len(marks) else marks[:, 0]
                new = np.nonzero(np.concatenate(([True], marks[1:, 0] > stop[:-1])))[0] if len(marks) else marks[:, 0]
                gone = np.zeros(len(text), bool)
                for x, y in zip(marks[new, 0].tolist(), stop[np.append(new[1:], len(marks)) - 1].tolist() if len(marks) else []):
                    gone[x:y] = True
                if whole_characters and len(text):
                    head = np.nonzero(text & 0xC0 != 0x80)[0]
                    head = head if len(head) and head[0] == 0 else np.concatenate(([0], head))
                    gone = np.repeat(np.logical_and.reduceat(gone, head), np.diff(np.append(head, len(text))))
                spans, kept = [], []
                for end, size in zip(ends.tolist(), sizes.tolist()):
                    own = gone[end - size : end]
                    edge = np.diff(np.concatenate(([0], own.view(np.int8), [0])).astype(np.int8))
                    spans.append([{"start": x, "end": y} for x, y in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist())])
                    kept.append(text[end - size : end][~own].tobytes())
                rest = pa.ipc.open_stream(unzip(row["rest"])).read_all()
                new = [pa.array(sizes), pa.array(spans, pairs), pa.array(kept, pa.binary())]
                for name, x in zip(("n_bytes", "spans", "kept"), new):
                    rest = rest.append_column(name, x)
                yield from rest.to_batches(max_chunksize=2000)

    return chunks.drop("ids", "n").join(marks.hint("merge"), "chunk", "left").mapInArrow(cut, schema)


def hot_marks(held: DataFrame, length: int) -> DataFrame:
    """(chunk, hot): places and counts of strings that repeat earlier ones, among runs of hot anchors.

    Content meets content: of equal runs, and then of equal strings of the runs left, all but the earliest are marked.
    Minima are aggregated before the shuffle; the joins back are merge joins, which adaptive execution splits where one
    content is hot. Left to itself Spark would broadcast by the size of compressed files: it counts no string that
    explode makes, and the driver would hold them all."""
    place = F.struct("id", "off", "chunk", "at")
    same = ["key", "anchor", "bytes"]
    first = materialise(held.groupBy(*same, "count").agg(F.min(place).alias("first")))
    again = held.join(first.drop("count").hint("merge"), same).where(place > F.col("first")).select("chunk", "at", "count")
    several = first.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    left = first.join(several.hint("merge"), "key", "left_semi").select("first", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("i"))
    string = F.substring(F.col("bytes"), F.col("i").cast("int") + 1, F.lit(length)).alias("string")
    left = left.select(string, F.struct("first.id", (F.col("first.off") + F.col("i")).alias("off"), "first.chunk", (F.col("first.at") + F.col("i")).alias("at")).alias("place"))
    low = left.groupBy("string").agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    single = left.join(low.hint("merge"), "string").where("place > low").select("place.chunk", "place.at", F.lit(1).cast("long").alias("count"))
    return again.union(single).groupBy("chunk").agg(F.collect_list(F.struct("at", "count")).alias("hot"))


def rewrite(docs: DataFrame) -> DataFrame:
    """docs with repeated passages cut from text; a character goes only if all of its bytes do. Columns stay as they
    are; null text becomes empty."""
    found = removed(docs, whole_characters=True)
    kind = docs.schema["text"].dataType
    return found.withColumn("text", F.decode("kept", "UTF-8").cast(kind)).select(*docs.columns)


by_value(__name__)
