import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from sparkfed.llm import packing

from .helpers import empty, frame, odd_documents

PATH = P.path("byte_bpe_50k.json")


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= items[i]:
                at = bins.index(room)
                bins[at] -= items[i]
                go(i + 1, bins)
                bins[at] += items[i]
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_the_best():
    rng = random.Random(4)
    for _ in range(250):
        capacity = rng.choice([10, 20, 37])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, left = packing.reduction(Counter(items), capacity)
        best = fewest(items, capacity)
        rest = list(Counter(left).elements())
        assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == best
        whole = packing.solve(Counter(items), capacity)
        assert all(sum(p) <= capacity for p, _ in whole)
        assert sum((Counter({s: k * n for s, k in Counter(p).items()}) for p, n in whole), Counter()) == Counter(items)
        assert sum(n for _, n in whole) <= best + 1


def test_large_histogram_is_near_its_bound():
    rng = random.Random(5)
    counts = Counter(min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(100_000))
    used = sum(n for _, n in packing.solve(counts, 1024))
    assert used <= 1.01 * sum(s * n for s, n in counts.items()) / 1024 + 1


@pytest.mark.parametrize("capacity,salt", [(1024, 20_000), (16, 7)])
def test_pack(spark, capacity, salt):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    rows = odd_documents()
    got = [r.asDict() for r in packing.pack(frame(spark, rows), PATH, capacity, 2, salt).collect()]
    want = Counter()
    for r in rows:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty(spark):
    assert packing.pack(empty(spark), PATH).count() == 0


def test_same_ids_as_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)  # as it comes: added tokens in a text are tokens
    assert 50256 in t.encode("x <|endoftext|> y", add_special_tokens=False).ids
    rng = random.Random(6)
    parts = ["<|endof", "text|>", "<|endoftext|>", "a", "the", " ", "  ", "\n", "é", "1", "<|endoftext|>", "'s", "日本", "!!", "\t", "\xa0"]
    assert packing.byte_ranks(PATH)
    encode = packing.encoder(PATH)
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
