import numpy as np

from sparkfed.llm import ann_forest

SCHEMA = "vec_id long, embedding array<float>, label int, query long, score double, block int"


def rows(n=400, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    if n > 90:
        x[50:90] = x[7]  # a hot vector, held by queries too
    out = [(i, [float(v) for v in x[i]], 0, 1, 0.5, 2) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [0.0] * dim, [nan] + [1.0] * (dim - 1), [inf] * dim, [None] + [1.0] * (dim - 1), [1.0, 2.0], []]
    out += [(1000 + 20 * i, v, None, None, None, None) for i, v in enumerate(odd)]
    return [*out, (None, [1.0] * dim, None, None, None, None)], x


def exact(x, q, k):
    d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((np.arange(len(x)), d)).tolist() if i != q][:k]
    return order, d[order]


def test_whole_recall_is_exact(spark):
    """With every entry a candidate, the forest gives the nearest rows themselves, ties by id, over several blocks."""
    data, x = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = ann_forest.nearest(df, "id % 20 = 0", k=10, recall=1.0, block=100, trees=4).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert sorted(by) == list(range(0, 400, 20))
    for q, found in by.items():
        ids, d = exact(x, q, 10)
        assert [i for i, _ in found] == ids and np.allclose([s for _, s in found], d, atol=1e-12)


def test_recall(spark):
    data, x = rows(1500, 32)
    df = spark.createDataFrame(data, SCHEMA)
    got = ann_forest.nearest(df, "id % 20 = 0 and id < 1000", k=10).collect()
    hits = sum(r["vec_id"] in exact(x, r["query_id"], 10)[0] for r in got)
    assert len(got) == 500 and hits >= 450


def forest(x, trees=ann_forest.TREES):
    normals = np.random.default_rng(7).standard_normal((x.shape[1], trees * ann_forest.BITS))
    return ann_forest.Forest(x, normals, x.mean(axis=0), trees)


def measured(x, asked, recall=ann_forest.RECALL):
    """Recall of the 10 nearest and the share of entries compared."""
    entry, _, compared = forest(x).nearest(x[asked], 10, recall)
    hits = sum(len(set(exact(x, q, 10)[0]) & set(e)) for q, e in zip(asked.tolist(), entry.tolist()))
    return hits / (10 * len(asked)), compared.mean() / len(x)


def test_spread_vectors_compare_a_part():
    """Evenly spread over a sphere, the worst case: still not near all, and the recall holds."""
    x = np.random.default_rng(5).standard_normal((4000, 64))
    recall, share = measured(x / np.linalg.norm(x, axis=1)[:, None], np.arange(0, 4000, 40))
    assert recall >= 0.92 and share <= 0.5


def test_clustered_vectors_compare_little():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((80, 64))[rng.integers(0, 80, 8000)] + 0.25 * rng.standard_normal((8000, 64))
    recall, share = measured(x, np.arange(0, 8000, 80))
    assert recall >= 0.92 and share <= 0.1


def test_ties_go_to_the_earlier_entry():
    """Corners at one distance from the query: the earliest are kept, however many steps the ascent takes."""
    x = np.concatenate([np.zeros((1, 12)), np.eye(12), -np.eye(12)]) + 3.0
    entry, far, compared = forest(x, 8).nearest(x[:1], 10, 1.0)
    assert entry[0].tolist() == list(range(11)) and far[0, 1:].tolist() == [1.0] * 10 and compared[0] == 25


def test_few_and_none(spark):
    df = spark.createDataFrame(rows(3, 4)[0][:3], SCHEMA)
    got = ann_forest.nearest(df, "id = 0", k=10).collect()
    assert [(r["query_id"], r["rank"]) for r in got] == [(0, 1), (0, 2)]
    assert ann_forest.nearest(spark.createDataFrame([], SCHEMA), "id = 0").count() == 0
