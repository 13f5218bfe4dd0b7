import random

from sparkfed.llm import simhash
from sparkfed.llm.common import components

from .helpers import empty, frame, odd_documents


def near(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def low_ids(pairs):
    """Smallest id of each row's component by brute force over all fingerprints."""
    fps = sorted({fp for _, fp in pairs})
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if near(a, b) <= 4:
                root[max(top(a), top(b))] = min(top(a), top(b))
    low = {}
    for i, fp in pairs:
        if i is not None:
            low[top(fp)] = min(low.get(top(fp), i), i)
    return [(i, fp, low.get(top(fp))) for i, fp in pairs]


def test_groups(spark):
    rows = odd_documents()
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_groups(frame(spark, rows)).collect()]
    want = low_ids([(r[0], (f := simhash.fingerprint(r[1])) - (f >> 63 << 64)) for r in rows])
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty(spark):
    assert simhash.near_groups(empty(spark)).count() == 0


def test_fingerprint():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n ") == 0
    assert simhash.fingerprint("A b\tC") == xxhash.xxh64_intdigest(b"a b c", 42)
    text = [f"w{i % 9}" for i in range(50)]
    count = [0] * 64
    for i in range(47):
        h = xxhash.xxh64_intdigest(" ".join(text[i : i + 4]), 42)
        count = [c + (h >> b & 1) for b, c in enumerate(count)]
    assert simhash.fingerprint(" ".join(text)) == sum(1 << b for b, c in enumerate(count) if 2 * c > 47)


def test_masks_cover():
    """Any four or fewer positions are hidden together by some mask, at every level of refinement."""
    rng = random.Random(2)
    for n in (64, 32, 16):
        masks = simhash.masks(list(range(n)))
        assert {m.bit_count() for m in masks} == {n // 2}
        for _ in range(3000):
            change = sum(1 << p for p in rng.sample(range(n), rng.randint(1, 4)))
            assert any(m & change == 0 for m in masks)


def test_hot_buckets(spark):
    """Hundreds of neighbours in one bucket go through refinement and lose no link."""
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base ^ (rng.getrandbits(10) << 20) for _ in range(700)} | {rng.getrandbits(64) for _ in range(100)}
    signed = [x - (x >> 63 << 64) for x in fps]
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket=256)
    assert links.count() < 50 * len(fps)
    root = {r["node"]: r["root"] for r in components(links).collect()}
    want = {fp: low for fp, _, low in low_ids([(x, x) for x in signed])}
    assert all(root.get(x, x) == want[x] for x in signed)


def test_keep_first(spark):
    rows = odd_documents()
    df = frame(spark, rows)
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 1004 not in ids and 1005 not in ids and 3 in ids and ids.count(None) == 2 and ids.count(5) == 2
    assert sum(i in (1000, 1001, 1002) for i in ids) == 1


def test_keep_first_at_the_bound(spark):
    """Near copies of similarity 0.8 to 0.95 go, whatever their SimHash distance; those under 0.8 stay."""
    rng = random.Random(8)
    rows = []
    for g in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        rows.append((len(rows), " ".join(own)))
        for edits in (1, 2, 3, 6):
            copy = list(own)
            for at in rng.sample(range(len(own)), edits):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for _, t in rows]
    root = list(range(len(rows)))
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if i // 5 == j // 5 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for i, j in pairs:
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    kept = {r["doc_id"] for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i for i, r in enumerate(root) if i == r}
    assert want <= kept and len(kept - want) <= 0.03 * (len(rows) - len(want))
    assert 60 < len(want) < 200


def test_keep_first_links_by_simhash(spark):
    """Near copies that only their SimHash fingerprints bring together: no band of least shingles is shared."""
    rows = []
    for seed in (1486, 30277):
        rng = random.Random(seed)
        own = [f"w{rng.randrange(10**6)}" for _ in range(14)]
        a, b = " ".join(own), " ".join([*own[:-1], f"x{rng.randrange(10**6)}"])
        assert near(simhash.fingerprint(a, 5), simhash.fingerprint(b, 5)) <= 4
        x, y = simhash.shingles(a), simhash.shingles(b)
        assert simhash.similarity(x, y) >= 0.8 and not set(simhash.band_keys(x, simhash.multipliers())) & set(simhash.band_keys(y, simhash.multipliers()))
        rows += [(len(rows), a), (len(rows) + 1, b)]
    rows.append((4, " ".join(f"y{i}" for i in range(14))))
    assert sorted(r["doc_id"] for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [0, 2, 4]
