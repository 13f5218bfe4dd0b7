"""Brown's class-based n-grams: exchange clustering, and scores from class transitions and word emissions.

All training texts are counted in parallel, and every word with a training count of FLOOR or more gets one of CLASSES
classes by the exchange algorithm, in two steps:

1.  The CORE most frequent words on the driver: each in turn moves to the class that raises the likelihood of the class
    bigrams most, until none moves or for ROUNDS rounds. The instance is a table of (CORE + TAILS)^2 bigram counts at
    most, whatever the corpus' size.
2.  All other words over the floor on the executors, however many: each one's counts by the class of the word before it
    are gathered once, and in each of BATCH_ROUNDS rounds every word moves to the class that raises the likelihood most
    against the tables of the round before, or to none. Then the tables, of fixed size, are summed anew.

Words under the floor, and unseen ones, have one of TAILS classes by their last letters.

    p(word | previous word) = p(class | context of the previous word) * p(word | class)

While classes are sought, the context is the class for the core's words, and the tail class for all others: so the counts
of step 2 stay right while its words move, and a round's gain is the exact gain of one word's move. With class_context,
as in op1, class bigrams are then counted anew over all texts with every word's own class as the context too, whether it
is of the core, of step 2 or a tail class; for that, hashes and classes of step 2's words beside the HEAD (10 bytes each)
go to the workers. Transitions are smoothed towards the
classes' own frequencies; emissions of the tail classes keep room for one unseen word each, so probabilities of all
words, with one unseen in each tail class, sum to one.

Texts are read as such twice: for the words' counts, and to be encoded, a number a token. The core and the HEAD most
frequent words, at most, have numbers of their own, by a table of that fixed size, which every worker holds; the others
stand beside. Bigrams, contexts and scores come from the numbers; when scored, a text's other words are joined with the
distributed counts and classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, free, give_back, materialise

CLASSES, CORE, TAILS, HEAD = 96, 2048, 64, 100_000
#: The least training count of a word that is clustered.
FLOOR = 100
ROUNDS, BATCH_ROUNDS = 8, 3
#: Bits of the filter by which tasks pass over most words under the floor; what it lets through is counted exactly.
FILTER = 1 << 24
#: Training tokens for which there is one bucket of words, where their counts by context meet.
BUCKET = 1_000_000
#: Added to every count of a word, and the weight of the class frequencies in a transition.
ADD, PULL = 0.1, 5.0
#: The token that ends a text, and stands before its first word; no word holds a line break.
END = b"\n"
#: Columns of intermediate results.
ROW, REST, CODES, RARE = "__sparkfed_row", "__sparkfed_rest", "__sparkfed_codes", "__sparkfed_rare"


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case, then the end."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def tail_class(word: bytes, tails: int) -> int:
    import zlib

    return zlib.crc32(word[-3:]) % tails


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; partial counts of a task are bounded and meet in a shuffle."""
    import pandas as pd

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        seen: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                seen.update(tokens(t))
                if len(seen) > 300_000:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    return docs.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Symbols(dict):
    """word -> its place among words, else their number + tail class."""

    def __init__(self, words: list[bytes], tails: int):
        super().__init__({w: i for i, w in enumerate(words)})
        self.base, self.tails, self.fixed = len(words), tails, len(words)

    def __missing__(self, word: bytes) -> int:
        s = self.base + tail_class(word, self.tails)
        if len(self) < self.fixed + 200_000:
            self[word] = s
        return s


def encode(docs: DataFrame, words: list[bytes], tails: int) -> DataFrame:
    """docs without text, with the numbers of its tokens by Symbols (CODES, 32 bits each), and the tokens that are not of
    words, with spaces between them (RARE). Null text counts as empty: the end alone."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    keep = [f for f in docs.schema.fields if f.name not in {"text", CODES, RARE}]
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator) -> Iterator:
        of = Symbols(shared.value, tails)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = [tokens(t) for t in part.column("text").to_pylist()]
                flat = [w for x in texts for w in x]
                s = np.fromiter(map(of.__getitem__, flat), np.int32, len(flat))
                cuts = np.cumsum([0, *map(len, texts)])
                lost = np.nonzero(s >= of.base)[0]
                of_text = np.searchsorted(lost, cuts).tolist()
                lost = [flat[i] for i in lost.tolist()]
                codes = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(s)])
                rare = pa.array([b" ".join(lost[i:j]) for i, j in zip(of_text, of_text[1:])], pa.binary())
                rest = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*rest.columns, codes, rare], names=[*rest.schema.names, CODES, RARE])

    new = [T.StructField(CODES, T.BinaryType()), T.StructField(RARE, T.BinaryType())]
    return docs.select(*(f.name for f in keep), "text").mapInArrow(run, T.StructType([*keep, *new]))


def slices(batches: Iterator) -> Iterator:
    """(rows, their tokens' numbers, where each row's begin) of encode()'s rows, some hundred at a time."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            codes = part.column(CODES).cast(pa.binary())
            cuts = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]
            s = np.frombuffer(codes.buffers()[2], np.uint8)[cuts[0] : cuts[-1]].view(np.int32)
            yield part, s, (cuts[:-1] - cuts[0]) // 4


def rare_words(part) -> list[bytes]:
    return [w for t in part.column(RARE).to_pylist() if t for w in t.split(b" ")]


def previous(s, begin, start: int):
    """The token before each; start before a text's first."""
    import numpy as np

    out = np.empty_like(s)
    out[1:] = s[:-1]
    out[begin] = start
    return out


def count_pairs(coded: DataFrame, words: list[bytes], tail, core: int, tails: int) -> DataFrame:
    """(code, n): bigrams of symbols over all texts, code = first * size + second; symbols are the first `core` words and
    the tail classes. tail: of each word."""
    import numpy as np
    import pyarrow as pa

    size = core + tails
    symbol = np.concatenate((np.arange(core), core + tail[core:], core + np.arange(tails)))
    start = int(symbol[Symbols(words, tails)[END]])

    def run(batches: Iterator) -> Iterator:
        codes, held, out = [], 0, np.zeros(size * size, np.int64)  # 36 MB, whatever the texts
        for _, s, begin in slices(batches):
            s = symbol[s]
            codes.append(previous(s, begin, start) * size + s)
            held += len(s)
            if held > 2_000_000:
                out += np.bincount(np.concatenate(codes), minlength=len(out))
                codes, held = [], 0
        if codes:
            out += np.bincount(np.concatenate(codes), minlength=len(out))
        u = np.nonzero(out)[0]
        for at in range(0, len(u), 500_000):
            part = u[at : at + 500_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(out[part])], names=["code", "n"])

    return coded.select(CODES).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def exchange(pairs, n_words: int, tails: int, classes: int, rounds: int = ROUNDS):
    """The class of each symbol; pairs: a dense matrix of bigram counts of symbols. Tail symbols keep their own."""
    import numpy as np

    size = n_words + tails
    k = classes + tails
    of = np.concatenate((np.arange(n_words) % classes, classes + np.arange(tails)))
    one = np.zeros((size, k))
    one[np.arange(size), of] = 1
    after, before = pairs @ one, pairs.T @ one  # of each word: counts by the next and by the previous word's class
    both = one.T @ after
    total = pairs.sum(axis=1), pairs.sum(axis=0)
    row, col = both.sum(axis=1), both.sum(axis=0)

    def h(x):
        return x * np.log(np.maximum(x, 1e-300))

    order = np.argsort(-total[1][:n_words], kind="stable").tolist()
    for _ in range(rounds):
        moved = 0
        for w in order:
            a, own = of[w], pairs[w, w]
            out, back = after[w].copy(), before[w].copy()
            out[a] -= own
            back[a] -= own
            both[a] -= out
            both[:, a] -= back
            both[a, a] -= own
            row[a] -= total[0][w]
            col[a] -= total[1][w]
            # likelihood gained by adding w to each class: its row, its column and the cell where they cross
            to, fro = np.nonzero(out)[0], np.nonzero(back)[0]
            part = both[:classes, to]
            rows = (h(part + out[to]) - h(part)).sum(1)
            part = both[fro, :classes]
            cols = (h(part + back[fro, None]) - h(part)).sum(0)
            d = np.arange(classes)
            cell = both[d, d]
            cross = h(cell + out[d] + back[d] + own) - h(cell + out[d]) - h(cell + back[d]) + h(cell)
            gain = rows + cols + cross - h(row[:classes] + total[0][w]) + h(row[:classes]) - h(col[:classes] + total[1][w]) + h(col[:classes])
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            both[b] += out
            both[:, b] += back
            both[b, b] += own
            row[b] += total[0][w]
            col[b] += total[1][w]
            if b != a:
                moved += 1
                of[w] = b
                after[:, a] -= pairs[:, w]
                after[:, b] += pairs[:, w]
                before[:, a] -= pairs[w]
                before[:, b] += pairs[w]
        if not moved:
            break
    return of


def top_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most `most` of them: those over a threshold that a histogram of counts gives."""
    scale = F.floor(F.log2(F.col("c").cast("double")) * 32)
    bins = sorted(((r["b"], r["n"]) for r in words.groupBy(scale.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)  # 64 * 32 at most
    total, low = 0, None
    for b, n in bins:
        total += n
        if total > most:
            break
        low = b
    return words.where(scale >= low) if low is not None else words.orderBy(F.desc("c"), "word").limit(most)


def core_words(words: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The `most` most frequent words, by count and then bytes, with their counts; four times as many at most reach the
    driver."""
    near = top_words(words, 4 * most).select("word", "c").toArrow()
    if near.num_rows < most and words.limit(most + 1).count() > near.num_rows:  # the first bin alone is over the bound
        near = words.select("word", "c").orderBy(F.desc("c"), "word").limit(most).toArrow()
    pairs = sorted(zip((-c for c in near["c"].to_pylist()), near["word"].to_pylist()))
    return [(w, -c) for c, w in pairs[:most]]


def word_hashes(words: list[bytes]):
    """Spark's hashes of the words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)


def word_filter(words: DataFrame, floor: int) -> bytes:
    """A bit for each value of the words' hashes modulo FILTER; of fixed size."""
    import numpy as np

    bit = F.pmod(F.xxhash64("word"), F.lit(FILTER))
    rows = words.where(F.col("c") >= floor).groupBy(F.shiftright(bit, 5).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(word), {FILTER}) & 31 as int))")).alias("bits")).toArrow()
    out = np.zeros(FILTER // 32, np.uint32)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out.tobytes()


class Contexts(dict):
    """word -> its number, from `first` on, if it passes the filter; else -1. held, tail: hashes and tail classes of the
    words that passed."""

    def __init__(self, first: int, tails: int, bits: bytes):
        super().__init__()
        self.first, self.tails = first, tails
        self.bits, self.held, self.tail = bits, [], []

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        h = xxh64_intdigest(word, 42)
        bit = h % FILTER
        if self.bits[bit >> 3] >> (bit & 7) & 1:
            s = self[word] = self.first + len(self.held)
            self.held.append(h - (h >> 63 << 64))
            self.tail.append(tail_class(word, self.tails))
            return s
        if len(self) < 300_000:
            self[word] = -1
        return -1

    def clear_held(self) -> None:
        for w in [w for w, s in self.items() if s >= self.first]:
            del self[w]
        self.held, self.tail = [], []


#: A word's hash, its tail class, a context, and the word's count in it.
ENTRY = [("h", "<i8"), ("t", "<i4"), ("p", "<i4"), ("n", "<i8")]


def entries(blobs: list[bytes]):
    import numpy as np

    return np.frombuffer(b"".join(blobs), ENTRY)


def folded(found):
    """Entries in order of hash and context, with the counts of equal ones added up."""
    import numpy as np

    if not len(found):
        return found
    found = found[np.lexsort((found["p"], found["h"]))]
    new = np.concatenate(([True], (found["h"][1:] != found["h"][:-1]) | (found["p"][1:] != found["p"][:-1])))
    out = found[new].copy()
    out["n"] = np.add.reduceat(found["n"], np.nonzero(new)[0])
    return out


def count_contexts(coded: DataFrame, head: tuple, core: int, of, tails: int, bits: bytes, floor: int, buckets: int) -> DataFrame:
    """(bucket, blob): entries of words over the floor outside the core, by their hashes' bucket; each task adds up its
    own. head: words, counts and tail classes; of its words those over the floor are counted, of all others those that
    pass the filter."""
    import numpy as np
    import pyarrow as pa

    words, counts, tail = head
    far = np.nonzero(counts[core:] >= floor)[0] + core
    number = np.full(len(words) + tails, -1)
    number[far] = np.arange(len(far))
    of = np.asarray(of, np.int64)
    context = of[np.concatenate((np.arange(core), core + tail[core:], core + np.arange(tails)))]
    start = int(context[Symbols(words, tails)[END]])
    width = int(of.max()) + 1 if len(of) else 1
    shared = coded.sparkSession.sparkContext.broadcast((number, context, word_hashes([words[i] for i in far.tolist()]), tail[far], bits))
    first, base, any_rare = len(far), len(words), any(bits)

    def run(batches: Iterator) -> Iterator:
        number, context, far_hash, far_tail, bits = shared.value
        rare = Contexts(first, tails, bits)
        keys, held, known, counts = [], 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def fold() -> None:
            nonlocal keys, held, known, counts
            u, n = np.unique(np.concatenate([known[:0], *keys]), return_counts=True)
            known, where = np.unique(np.concatenate((known, u)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, n)), len(known)).astype(np.int64)
            keys, held = [], 0

        def emit() -> Iterator:
            nonlocal known, counts
            fold()
            w = known // width
            out = np.empty(len(known), ENTRY)
            out["h"] = np.concatenate((far_hash, np.array(rare.held, np.int64)))[w]
            out["t"] = np.concatenate((far_tail, np.array(rare.tail, np.int64)))[w]
            out["p"], out["n"] = known % width, counts
            to = out["h"] % buckets
            order = np.argsort(to, kind="stable")
            cuts = np.append(np.nonzero(np.diff(to[order], prepend=-1))[0], len(order))
            for at in range(0, len(cuts) - 1, 64):
                part = list(zip(cuts[at : at + 64], cuts[at + 1 : at + 65]))
                blobs = pa.array([out[order[i:j]].tobytes() for i, j in part], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([int(to[order[i]]) for i, _ in part], pa.int64()), blobs], names=["bucket", "blob"])
            known, counts = known[:0], counts[:0]
            rare.clear_held()

        for part, s, begin in slices(batches):
            w = number[s]
            if any_rare:
                lost = np.nonzero(s >= base)[0]
                w[lost] = np.fromiter(map(rare.__getitem__, rare_words(part)), np.int64, len(lost))
            at = np.nonzero(w >= 0)[0]
            keys.append(w[at] * width + previous(context[s], begin, start)[at])
            held += len(at)
            if held > 1_000_000:
                fold()
                if len(known) > 4_000_000 or len(rare.held) > 400_000:
                    yield from emit()
        yield from emit()

    return coded.select(CODES, *([RARE] if any_rare else [])).mapInArrow(run, "bucket long, blob binary")


def merge_contexts(found: DataFrame, floor: int) -> DataFrame:
    """(h, t, n, blob, class): one row for each hash with a count of `floor` or more; class is null. What is held of a
    bucket is bounded by its different words and contexts: its rows are added up as they come."""
    import numpy as np
    import pandas as pd

    def close(held) -> Iterator:
        x = folded(entries(held))
        cuts = np.append(np.nonzero(np.concatenate(([True], x["h"][1:] != x["h"][:-1])))[0], len(x)) if len(x) else np.zeros(1, int)
        total = np.add.reduceat(x["n"], cuts[:-1]) if len(x) else x["n"]
        keep = np.nonzero(total >= floor)[0]
        for i in range(0, len(keep), 5000):
            k = keep[i : i + 5000]
            at = cuts[k]
            yield pd.DataFrame({"h": x["h"][at], "t": x["t"][at], "n": total[k], "blob": [x[cuts[j] : cuts[j + 1]].tobytes() for j in k.tolist()], "class": pd.array([None] * len(k), dtype="Int32")})

    def run(batches: Iterator) -> Iterator:
        now, held, size = None, [], 0
        for b in batches:
            for bucket, blob in zip(b["bucket"].tolist(), b["blob"].tolist()):
                if bucket != now:
                    yield from close(held)
                    now, held, size = bucket, [], 0
                held.append(blob)
                size += len(blob)
                if size > 64_000_000 and size > 2 * len(held[0]):
                    held = [folded(entries(held)).tobytes()]
                    size = len(held[0])
        yield from close(held)

    return found.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(run, "h long, t int, n long, blob binary, class int")


class Own(dict):
    """word -> its own class: of clustered words theirs, else the tail class."""

    def __init__(self, near: tuple, classes: int, tails: int):
        super().__init__()
        self.hashes, self.found, self.classes, self.tails = *near, classes, tails

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        s = self.classes + tail_class(word, self.tails)
        if len(self.hashes):
            h = xxh64_intdigest(word, 42)
            h -= h >> 63 << 64
            i = int(self.hashes.searchsorted(h))
            if i < len(self.hashes) and self.hashes[i] == h:
                s = int(self.found[i])
        if len(self) < 300_000:
            self[word] = s
        return s


def clustered(rows: DataFrame) -> tuple:
    """Sorted hashes and the classes of merge_contexts()' words that have one: 10 bytes a word, of those over the floor."""
    import numpy as np

    got = rows.where(F.col("class").isNotNull()).select("h", F.col("class").cast("short").alias("class")).toArrow()
    h, cls = got["h"].to_numpy(), got["class"].to_numpy()
    order = np.argsort(h)
    return h[order], cls[order]


def beside(near: tuple, words: list[bytes]) -> tuple:
    """near without the given words."""
    import numpy as np

    left = ~np.isin(near[0], word_hashes(words))
    return near[0][left], near[1][left]


def class_pairs(coded: DataFrame, words: list[bytes], cls, near: tuple, classes: int, tails: int):
    """The table (class, class of the next word) of counts over all texts; each task sends its sums, of fixed size.
    cls: the classes of encode()'s numbers."""
    import numpy as np
    import pyarrow as pa

    k = classes + tails
    start, base, any_rare = int(cls[Symbols(words, tails)[END]]), len(words), len(near[0]) > 0
    shared = coded.sparkSession.sparkContext.broadcast((cls, near))

    def run(batches: Iterator) -> Iterator:
        cls, near = shared.value
        of, out = Own(near, classes, tails), np.zeros(k * k, np.int64)
        for part, numbers, begin in slices(batches):
            s = cls[numbers]
            if any_rare:
                lost = np.nonzero(numbers >= base)[0]
                s[lost] = np.fromiter(map(of.__getitem__, rare_words(part)), np.int64, len(lost))
            out += np.bincount(previous(s, begin, start) * k + s, minlength=k * k)
        code = np.nonzero(out)[0]
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(out[code])], names=["code", "n"])

    got = coded.select(CODES, *([RARE] if any_rare else [])).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # k^2 rows at most
    table = np.zeros(k * k)
    table[got["code"].to_numpy()] = got["n"].to_numpy()
    return table.reshape(k, k)


def batch_exchange(rows: DataFrame, table, classes: int) -> DataFrame:
    """rows with each word's best class against the table (context, class) of counts, in which it is counted already;
    null: its tail class, column classes + t, is as good as any other."""
    import numpy as np
    import pandas as pd

    def h(x):
        return x * np.log(np.maximum(x, 1e-300))

    def run(batches: Iterator) -> Iterator:
        columns = table.sum(axis=0)
        ready = h(table[:, :classes])
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i : i + 500]
                blobs = part["blob"].tolist()
                x = entries(blobs)
                of = np.repeat(np.arange(len(part)), [len(y) // 24 for y in blobs])
                n, tail = part["n"].to_numpy(np.float64), classes + part["t"].to_numpy(np.int64)
                now = part["class"].to_numpy(np.float64, na_value=-1).astype(np.int64)
                now = np.where(now < 0, tail, now)
                # what each class is without the word
                cells, p, c = table[x["p"], :classes], x["p"], x["n"].astype(np.float64)
                own = now[of] < classes
                k = np.nonzero(own)[0]
                base = ready[p]
                cells[k, now[of[k]]] = np.maximum(cells[k, now[of[k]]] - c[k], 0)
                base[k, now[of[k]]] = h(cells[k, now[of[k]]])
                gain = h(cells + c[:, None]) - base
                cuts = np.concatenate(([0], np.cumsum([len(y) // 24 for y in blobs])[:-1]))
                gain = np.add.reduceat(gain, cuts, axis=0)
                sums = np.repeat(columns[None, :classes], len(part), axis=0)
                k = np.nonzero(now < classes)[0]
                sums[k, now[k]] -= n[k]
                gain -= h(sums + n[:, None]) - h(np.maximum(sums, 0))
                # and its tail class
                cell = table[p, tail[of]] - np.where(now[of] == tail[of], c, 0)
                stay = np.add.reduceat(h(np.maximum(cell, 0) + c) - h(np.maximum(cell, 0)), cuts)
                rest = np.maximum(columns[tail] - np.where(now == tail, n, 0), 0)
                stay -= h(rest + n) - h(rest)
                best = gain.argmax(axis=1)
                moved = gain[np.arange(len(part)), best] > stay + 1e-9
                yield part.assign(**{"class": pd.Series(pd.arrays.IntegerArray(best.astype(np.int32), ~moved), index=part.index)})

    return rows.mapInPandas(run, rows.schema)


def class_table(rows: DataFrame, table, classes: int):
    """The table once rows' words have gone from their tail classes to their classes; sums of fixed size."""
    import numpy as np
    import pandas as pd

    shape = table.shape

    def run(batches: Iterator) -> Iterator:
        out = np.zeros(shape, np.int64)
        for b in batches:
            blobs = b["blob"].tolist()
            x = entries(blobs)
            of = np.repeat(np.arange(len(b)), [len(y) // 24 for y in blobs])
            np.add.at(out, (x["p"], b["class"].to_numpy(np.int64)[of]), x["n"])
            np.add.at(out, (x["p"], classes + b["t"].to_numpy(np.int64)[of]), -x["n"])
        p, c = np.nonzero(out)
        yield pd.DataFrame({"p": p, "c": c, "n": out[p, c]})

    sums = rows.where(F.col("class").isNotNull()).mapInPandas(run, "p int, c int, n long").groupBy("p", "c").agg(F.sum("n").alias("n")).toArrow()
    new = table.copy()
    new[sums["p"].to_numpy(), sums["c"].to_numpy()] += sums["n"].to_numpy()
    return np.maximum(new, 0)


def log_likelihood(table) -> float:
    """Of the class bigrams less the classes' own counts: what exchange raises."""
    import numpy as np

    h = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
    return h(table) - h(table.sum(axis=0))


@dataclass
class Model:
    """words (word, c, class) of all training words, distributed, class null for a tail class; the rest is of fixed size."""

    words: DataFrame
    head: tuple[list[bytes], object, object]  # words, counts and classes (-1: tail) of the core and the most frequent
    n: int
    v: int
    context: object  # of core words and tails: the row of moves
    core: list[bytes]
    moves: object  # log10 p(class | context)
    mass: object  # the denominators of the classes' emissions, the tail classes' last
    classes: int
    tails: int
    near: tuple | None = None  # clustered() beside the head: every word's context is its own class
    coded: DataFrame | None = None  # train()'s docs as encode() leaves them, where learn is given


def train(
    docs: DataFrame, classes: int = CLASSES, core: int = CORE, tails: int = TAILS, head: int = HEAD, floor: int = FLOOR, batch_rounds: int = BATCH_ROUNDS, class_context: bool = False, learn: str | None = None
) -> Model:
    """Learns from every text of docs; null counts as empty. An empty table gives a model without words.

    class_context: class bigrams are of every word's own class, else contexts outside the core are tail classes.
    learn: a condition; only rows that meet it are learnt from, and all are encoded, to be scored as model.coded."""
    import numpy as np

    met = (lambda x: x) if learn is None else (lambda x: x.where(learn))
    counts = materialise(count_words(met(docs)))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    table_of = dict(core_words(counts, core))
    first = list(table_of)
    m, size = len(first), len(first) + tails
    top = top_words(counts, head).select("word", "c").toArrow()
    table_of |= dict(zip(top["word"].to_pylist(), top["c"].to_pylist()))  # the core's places come first
    top, top_c = list(table_of), np.array(list(table_of.values()), np.int64)
    top_tail = np.array([tail_class(w, tails) for w in top], np.int64)
    coded = materialise(encode(docs, top, tails))
    classes = max(1, min(classes, m))
    pairs = np.zeros((size, size))
    found = materialise(count_pairs(met(coded), top, top_tail, m, tails))  # at most size^2 rows
    for part in range(8):
        got = found.where(F.pmod("code", F.lit(8)) == part).toArrow()
        pairs.ravel()[got["code"].to_numpy()] = got["n"].to_numpy()
        del got
    free(found)
    give_back()
    of = exchange(pairs, m, tails, classes) if m else np.arange(tails) + classes
    k = classes + tails
    one = np.zeros((size, k))
    one[np.arange(size), of] = 1
    core_table = one.T @ pairs @ one
    del pairs, one
    table = core_table
    far = word_filter(counts.where(F.col("c") >= floor).join(in_core(docs.sparkSession, top), "word", "left_anti"), floor)
    far = materialise(count_contexts(met(coded), (top, top_c, top_tail), m, of, tails, far, floor, max(1, n // BUCKET)))
    rows = materialise(merge_contexts(far, floor))
    free(far)
    for _ in range(batch_rounds):
        moved = materialise(batch_exchange(rows, table, classes))
        new = class_table(moved, core_table, classes)
        if log_likelihood(new) <= log_likelihood(table):
            free(moved)
            break
        rows, last, table = moved, rows, new
        free(last)
    near = clustered(rows) if class_context else None
    own = in_core(docs.sparkSession, first, of)
    picked = rows.where(F.col("class").isNotNull()).select("h", F.col("class").alias("far")).dropDuplicates(["h"])
    words = counts.withColumn("h", F.when(F.col("c") >= floor, F.xxhash64("word"))).join(picked, "h", "left").join(own, "word", "left")
    words = materialise(words.select("word", "c", F.coalesce("near", "far").alias("class")))
    free(counts, rows)
    types, mass = np.zeros(tails), np.zeros(tails)
    tail = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(tails)).alias("t")
    for r in words.where("class is null").groupBy(tail).agg(F.count(F.lit(1)).alias("types"), F.sum("c").alias("c")).collect():  # `tails` rows
        types[r["t"]], mass[r["t"]] = r["types"], r["c"]
    emitted = np.zeros(classes)
    for r in words.where("class is not null").groupBy("class").agg(F.sum("c").alias("c")).collect():  # `classes` rows
        emitted[r["class"]] = r["c"]
    got = words.where("class is not null").join(in_core(docs.sparkSession, top), "word", "left_semi").select("word", "class").toArrow()
    found = dict(zip(got["word"].to_pylist(), got["class"].to_pylist()))
    top_class = np.array([found.get(w, -1) for w in top], np.int64)
    if class_context:
        near = beside(near, top)
        numbers = np.concatenate((np.where(top_class < 0, classes + top_tail, top_class), classes + np.arange(tails)))
        table = class_pairs(met(coded), top, numbers, near, classes, tails)
    share = (table.sum(axis=0) + ADD) / (table.sum() + ADD * k)
    moves = np.log10((table + PULL * share) / (table.sum(axis=1, keepdims=True) + PULL))
    if learn is None:
        free(coded)
    give_back()
    mass = np.concatenate((emitted, mass + ADD * (types + 1)))
    return Model(words, (top, top_c, top_class), n, v, of, first, moves, mass, classes, tails, near, None if learn is None else coded)


def in_core(spark: SparkSession, core: list[bytes], of=None) -> DataFrame:
    """(word, near): the given words, a table of fixed size, with the core's classes."""
    import pandas as pd

    near = [int(x) for x in of[: len(core)]] if of is not None else [0] * len(core)
    return F.broadcast(spark.createDataFrame(pd.DataFrame({"word": core, "near": near}), "word binary, near int"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs (without text) with n_tokens, n_known, base_score and score: log10 probabilities of the whole text by the
    words' smoothed frequencies and by the model. docs may also be model.coded.

    Null text counts as empty: the end alone. Each row is scored for itself, so repeated rows and ties change nothing;
    a very long text is held as its words, a few dozen bytes each. Columns named like the results are replaced; an empty
    table gives no rows."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    names = ["n_tokens", "n_known", "base_score", "score"]
    keep = [f for f in docs.schema.fields if f.name not in {*names, "text", CODES, RARE}]
    moves, mass, classes, tails = model.moves, model.mass, model.classes, model.tails
    words, counts, cls = model.head
    coded = docs if docs is model.coded else encode(docs.select(*(f.name for f in keep), "text"), words, tails)
    spark = docs.sparkSession
    lower = model.n + ADD * (model.v + 1)
    # of encode()'s numbers, the tail classes' last
    in_tail = cls < 0
    cls = np.where(in_tail, classes + np.array([tail_class(w, tails) for w in words], np.int64), cls)
    own = cls if model.near is not None else np.array([classes + tail_class(w, tails) for w in words], np.int64)
    own = np.concatenate((np.asarray(model.context, np.int64)[: len(model.core)], own[len(model.core) :]))
    context = np.concatenate((own, classes + np.arange(tails)))
    c = counts.astype(np.float64)
    base = np.log10((c + ADD) / lower) if len(c) else c
    emit = np.log10(np.where(in_tail, c + ADD, c)) - np.log10(mass[cls]) if len(c) else c
    start, n_head = int(context[Symbols(words, tails)[END]]), len(words)
    near = (np.zeros(0, np.int64), np.zeros(0, np.int16)) if model.near is None else model.near
    any_near = len(near[0]) > 0
    shared = spark.sparkContext.broadcast((context, cls, base, emit, near))  # of fixed size, but for near

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        context, cls, base, emit, near = shared.value
        of_rare = Own(near, classes, tails)
        row = TaskContext.get().partitionId() << 33
        for part, i, begin in slices(batches):
            sizes = np.diff(begin, append=len(i)).astype(np.int64)
            known = i < n_head
            own, lost = i[known], np.nonzero(~known)[0]
            rare = rare_words(part)
            x = context[i]
            if any_near:
                x[lost] = np.fromiter(map(of_rare.__getitem__, rare), np.int64, len(rare))
            x = previous(x, begin, start)
            found = np.zeros((2, len(i)))
            found[:, known] = base[own], moves[x[known], cls[own]] + emit[own]
            found = np.add.reduceat(found, begin, axis=1)
            n_known = np.add.reduceat(known.astype(np.int64), begin)
            cuts = pa.array(np.concatenate(([0], np.cumsum(sizes - n_known))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(rare, pa.binary())), pa.ListArray.from_arrays(cuts, pa.array(x[lost].astype(np.int32)))]
            new = [pa.array(row + np.arange(part.num_rows)), pa.array(sizes), pa.array(n_known), pa.array(found[0]), pa.array(found[1]), *lists]
            row += part.num_rows
            rest = part.select([f.name for f in keep])
            yield pa.RecordBatch.from_arrays([*rest.columns, *new], names=[*rest.schema.names, ROW, *names, REST, REST + "x"])

    plain = [T.StructField(ROW, T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    lists = [T.StructField(REST, T.ArrayType(T.BinaryType())), T.StructField(REST + "x", T.ArrayType(T.IntegerType()))]
    part = materialise(coded.mapInArrow(run, T.StructType([*keep, *plain, *lists])))
    lost = part.select(ROW, F.explode(F.arrays_zip(REST, REST + "x")).alias("x")).select(ROW, F.col(f"x.{REST}").alias("word"), F.col(f"x.{REST}x").alias("x"))
    step = spark.createDataFrame([(i * (classes + tails) + j, float(moves[i, j]), float(mass[j])) for i in range(len(moves)) for j in range(classes + tails)], "step long, move double, mass double")
    tail = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(tails))
    lost = lost.join(model.words, "word", "left").withColumn("step", F.col("x") * F.lit(classes + tails) + F.coalesce("class", classes + tail))
    lost = lost.join(F.broadcast(step), "step")  # (classes + tails)^2 rows, whatever the corpus
    c = F.coalesce("c", F.lit(0))
    sums = lost.groupBy(ROW).agg(
        F.sum(F.when(F.col("c").isNotNull(), 1).otherwise(0)).alias("_known"),
        F.sum(F.log10((c + ADD) / lower)).alias("_base"),
        F.sum(F.col("move") + F.log10(F.when(F.col("class").isNull(), c + ADD).otherwise(c) / F.col("mass"))).alias("_score"),
    )
    both = part.drop(REST, REST + "x").join(sums, ROW, "left")
    plus = lambda a, b, zero: (F.col(a) + F.coalesce(b, F.lit(zero))).alias(a)
    return both.select(*(f.name for f in keep), "n_tokens", plus("n_known", "_known", 0), plus("base_score", "_base", 0.0), plus("score", "_score", 0.0))


by_value(__name__)
