import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from sparkfed.llm import suffix_dedup

from .helpers import empty, frame, odd_documents


def brute(docs, length):
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        b = text.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        out[i] = (len(b), sum(gone), sum(gone[j] and (not j or not gone[j - 1]) for j in range(len(b))), bytes(x for x, g in zip(b, gone) if not g))
    return out


def documents():
    rng = random.Random(5)
    base = ["".join(rng.choice("abé c\n") for _ in range(400)) for _ in range(6)]
    docs = {}
    for i in range(120):
        text = ""
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, 300)
            text += rng.choice(base)[a : a + rng.randint(1, 400)] + "".join(rng.choice("xyz") for _ in range(rng.choice([0, rng.randint(0, 90)])))
        docs[i] = text + rng.choice(["", "", "a" * rng.randint(90, 400), "ab" * rng.randint(60, 300)])
    return docs


def test_against_brute_force(spark):
    docs = documents()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    want = brute(docs, 100)
    # with and without several chunks, buckets, hot anchors and texts that are cut into units
    for chunk, bucket, hot in ((3000, 4000, 64), (10**7, 10**7, 64), (2000, 4000, 3), (400, 20_000, 1)):
        got = suffix_dedup.removed(df, chunk=chunk, bucket=bucket, hot=hot).collect()
        assert {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in got} == want


def test_collisions_are_caught():
    """With a hash that says little, the bytes decide."""
    rng = np.random.default_rng(1)
    data = np.frombuffer(bytes(rng.integers(97, 99, 3000, dtype=np.uint8)), np.uint8)
    s = suffix_dedup.Suffixes(data, 200)
    s.prefix = s.prefix & np.uint64(0)
    s.hash = lambda at, size: np.zeros(len(at), np.uint64)
    starts, sizes = np.arange(2000), np.full(2000, 10)
    order, head = s.sort(starts, sizes, np.zeros(2000, np.uint64))
    text = bytes(data)
    first = {}
    for i in range(2000):
        first.setdefault(text[i : i + 10], i)
    assert all(starts[order[h]] == first[text[starts[o] : starts[o] + 10]] for o, h in zip(order, head))


def test_sort_is_lexicographic():
    rng = np.random.default_rng(2)
    data = np.frombuffer(bytes(rng.integers(97, 100, 4000, dtype=np.uint8)), np.uint8)
    s = suffix_dedup.Suffixes(data, 200)
    starts = np.arange(3000)
    order, _ = s.sort(starts, np.full(3000, 50), np.zeros(3000, np.uint64))
    assert order.tolist() == sorted(range(3000), key=lambda i: (bytes(data[i : i + 50]), i))


def test_odd_rows(spark):
    rows = odd_documents()
    df = frame(spark, rows)
    out = suffix_dedup.removed(df)
    assert "spans" in out.columns and out.count() == len(rows)
    text = suffix_dedup.rewrite(df)
    assert text.columns == df.columns and text.count() == len(rows) and text.where(F.col("text").isNull()).count() == 0
    got = {r["doc_id"]: r["text"] for r in text.collect()}
    assert got[1004] == "" and got[1000] == "" and got[0] is not None
    assert suffix_dedup.removed(empty(spark)).count() == 0


def test_characters_stay_whole(spark):
    a, b = "é" * 60, "é" * 60
    got = suffix_dedup.rewrite(spark.createDataFrame([(1, "x" + a), (2, "y" + b)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got}[2] == "y"
    assert hashlib.sha256(got[0]["text"].encode()).digest()


def test_joins_are_not_broadcast(spark):
    """Near copies of hot passages: small files hold many strings, which a broadcast would gather on the driver."""
    rng = random.Random(4)
    lines = [("".join(rng.choice("abcd ") for _ in range(60)), "".join(rng.choice("abcd ") for _ in range(60))) for _ in range(20)]
    rows = [(i, "\n".join(f"{a} {rng.randrange(3)} {b}" for a, b in lines)) for i in range(40)]
    found = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string"), chunk=2000, hot=3)
    assert {r["doc_id"]: bytes(r["kept"]) for r in found.collect()} == {i: x[3] for i, x in brute(dict(rows), 100).items()}
    held = spark.createDataFrame([(1, i, 0, 0, 0, 1, i, b"x" * 100) for i in range(9)], "key long, id long, off long, at long, anchor long, count long, chunk long, bytes binary")
    for df in (found, suffix_dedup.hot_marks(held, 100)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
