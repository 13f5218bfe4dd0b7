"""Packing of documents into sequences: Martello and Toth's dominance reduction, then best fit for the rest.

A document's ids with a closing id are one item; only one longer than a sequence is cut, into full sequences after a
first piece that takes the remainder. Items differ, for packing, in their length alone. So the instance is a histogram
of at most `capacity` counts, whatever the corpus' size; it is solved on the driver, many items at a time, and gives
patterns: which lengths go together, and how often. Executors then number the items of each length and look their
places up. Numbers come from sums over parts of about SALT_ROWS items of each length, so a length that a third of all
items has is no single task's work.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, give_back, materialise, worker_cache

#: How a byte-level tokenizer cuts a text before it merges: a fixed value.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SALT_ROWS = 1000


def reduction(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed patterns with how often each, counts that are left).

    For the largest length s: alone if nothing fits beside it; with t, the largest that fits, if both fill the
    sequence, or if no two others fit beside s, or if at most two others do and none such pair exceeds t. In each
    case the set dominates every other one that holds s, so some best packing has it. A length for which none of these
    holds is set aside, and comes back when the smallest lengths have changed."""
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[tuple[tuple[int, ...], int]] = []
    again = True
    while again:
        again = False
        for s in sorted(left, reverse=True):
            while left.get(s, 0) > 0:
                def others(x: int) -> int:
                    return left.get(x, 0) - (x == s)

                room = capacity - s
                fits = [t for t in left if t <= room and others(t) > 0]
                if not fits:
                    n = left.pop(s) if 2 * s > capacity or left[s] == 1 else 1
                    fixed.append(((s,), n))
                    if s in left:
                        left[s] -= n
                    again = True
                    continue
                t = max(fits)
                small = []
                for x in sorted(fits):
                    small += [x] * min(3, others(x))
                    if len(small) >= 3:
                        break
                good = t == room or len(small) < 2 or small[0] + small[1] > room
                if not good and (len(small) < 3 or sum(small[:3]) > room):
                    good = best_pair(fits, others, room) <= t
                if not good:
                    break
                # As often as neither runs out. What was compared stays true while counts fall, but for the pair
                # sums, which only fall too.
                n = left[s] // 2 if t == s else min(left[s], left[t])
                fixed.append(((s, t), n))
                for x in (s, t):
                    left[x] -= n
                for x in {s, t}:
                    if not left[x]:
                        del left[x]
                again = True
    return fixed, left


def best_pair(fits: list[int], others, room: int) -> int:
    """The largest sum of two lengths that fit together."""
    sizes, best = sorted(fits), 0
    i, j = 0, len(sizes) - 1
    while i <= j:
        total = sizes[i] + sizes[j]
        if total > room:
            j -= 1
        elif i == j:
            best = max(best, total) if others(sizes[i]) > 1 else best
            break
        else:
            best = max(best, total)
            i += 1
    for x in sizes:  # two of one length
        if 2 * x <= room and others(x) > 1:
            best = max(best, 2 * x)
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: equal items go to equally filled sequences many at a time."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by the room left
    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            room = min((r for r in open_ if r >= s), default=capacity)
            pattern, have = open_[room].pop() if room in open_ else ((), n)
            if room in open_ and not open_[room]:
                del open_[room]
            each = room // s  # the fullest sequence that fits stays the fullest: it takes all it can
            many = min(have, n // each)
            put = []
            if many:
                put.append((pattern + (s,) * each, many, room - each * s))
            if many < have and (some := min(n - many * each, each - 1 if n // each <= many else 0)):
                put.append((pattern + (s,) * some, 1, room - some * s))
            used = sum(m for _, m, _ in put)
            if pattern and have > used:
                open_[room].append((pattern, have - used))
            for p, m, r in put:
                open_[r].append((p, m))
            n -= sum(m * (len(p) - len(pattern)) for p, m, _ in put)
    return [x for kept in open_.values() for x in kept]


def solve(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, left = reduction(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length: the first item numbers of runs, the sequence of each run's first item, and the offset."""
    out: dict[int, tuple[list[int], list[int], list[int]]] = defaultdict(lambda: ([], [], []))
    given: dict[int, int] = defaultdict(int)
    seq = 0
    for sizes, n in patterns:
        at = 0
        for s in sizes:
            first, seqs, offs = out[s]
            first.append(given[s])
            seqs.append(seq)
            offs.append(at)
            given[s] += n
            at += s
        seq += n
    return dict(out)


def byte_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """The ids of a tokenizer file's tokens by their bytes, and those of its added tokens by their text, if it is
    byte-level BPE whose merges are in the order of ids and which does no more; else None. Such a file says the same to
    any byte-pair encoder."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
        return None
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", ())):
        return None
    if any(a != b and a in b for a in added for b in added):  # which of two overlapping ones counts is the library's own rule
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(letter[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    return (ranks, added) if merged == sorted(merged) and len(ranks) == 256 + len(set(merged)) else None


def encoder(path: str):
    """The worker's function from a text to its ids as little-endian unsigned 32-bit integers, as the tokenizers library
    gives them without special tokens around it; added tokens that the text itself holds are tokens. A faster encoder
    does the work where the file allows that."""
    kept = worker_cache("packing")
    if path not in kept:
        import os

        import numpy as np

        kept.clear()
        found = byte_ranks(path)
        if found is not None:
            import tiktoken

            coder = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=found[0], special_tokens=found[1])
            kept[path] = lambda text: coder.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False).tobytes()
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            kept[path] = lambda text: np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return kept[path]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32."""
    import pandas as pd

    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import zlib

        encode, end = encoder(path), end_id.to_bytes(4, "little")
        for b in batches:
            for at in range(0, len(b), 500):
                rows = []
                part = b.iloc[at : at + 500]
                for i, text in enumerate(part["text"]):
                    ids = encode(text or "") + end
                    total = len(ids) // 4
                    cuts = [0, *range(total % capacity or capacity, total + 1, capacity)]
                    rows += [(i, k, x, y - x, zlib.crc32(ids[4 * x : 4 * y])) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))]
                out = pd.DataFrame(rows, columns=["row", "piece", "start", "length", "ids_crc32"])
                out.insert(0, "doc_id", part["doc_id"].iloc[out.pop("row").to_numpy()].reset_index(drop=True))
                yield out
            b = part = None
            give_back()

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece of each row of docs.

    Null text counts as empty (the closing id alone); null ids and repeated rows are packed like any other; a very long
    text is encoded whole, then cut; an empty table gives no rows; further columns are ignored."""
    from pyspark.sql import Window

    items = materialise(pieces(docs, path, capacity, end_id), batch=1000)
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    at = places(solve(counts, capacity))
    salts = F.get(F.array(*(F.lit(max(1, -(-counts.get(s, 0) // salt_rows))) for s in range(capacity + 1))), F.col("length").cast("int"))
    items = items.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts))
    parts = items.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    parts = parts.select("length", "_salt", before.alias("_before"))
    nth = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    items = items.withColumn("_nth", nth).join(parts, ["length", "_salt"]).withColumn("_nth", F.col("_nth") + F.col("_before")).drop("_salt", "_before")

    def place(batches: Iterator) -> Iterator:
        import numpy as np

        table = {s: tuple(np.array(x) for x in v) for s, v in at.items()}
        for b in batches:
            seq, off = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            nth, size = b["_nth"].to_numpy(), b["length"].to_numpy()
            for s in np.unique(size).tolist():
                i = np.nonzero(size == s)[0]
                first, seqs, offs = table[s]
                run = np.searchsorted(first, nth[i], side="right") - 1
                seq[i], off[i] = seqs[run] + nth[i] - first[run], offs[run]
            yield b.drop(columns="_nth").assign(sequence_id=seq, offset=off)

    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "_nth"]
    return items.select(*order).mapInPandas(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


by_value(__name__)
