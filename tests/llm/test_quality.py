import random
import re
from collections import Counter

import numpy as np

from sparkfed.llm import quality

from .helpers import empty, frame, odd_documents, words


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def clean(n=260, seed=1):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(25, 120)), "en", rng.choice(["a", "a", "b"])) for i in range(n)]
    return rows + [(n + i, " ".join(f"{x}%%% | ***" for x in words(rng, 60).split()), "en", "a") for i in range(12)]


def test_counts(spark):
    rows = odd_documents() + [(4000, "a b c d e f g h " * 3 + "tail", "en", "a"), (4001, "\U0001f600 é\x85x\xa0y #*", "en", "a")]
    got = quality.judged(frame(spark, rows)).collect()
    own = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    assert own == sorted((str(r[0]), *counts(r[1])) for r in rows)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_outliers(spark):
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, clean())).collect()}
    assert all(got[i]["kept"] for i in range(260)) and not any(got[260 + i]["kept"] for i in range(12))


def fitted(spark, rows):
    """The vectors of texts that pass the fixed rules, by id."""
    names = list(quality.STATS)
    df = quality.vector(quality.measured(frame(spark, rows)).withColumn("base_failed", quality.base_failed()))
    pdf = df.where("not base_failed").select("doc_id", *names).toPandas().sort_values("doc_id")
    return pdf["doc_id"].tolist(), pdf[names].to_numpy() / quality.POINT


def least_determinant(x, typical, share, trials=150, seed=5):
    """The minimum covariance determinant by many random starts, each concentrated until its subset stays the same."""
    rng, n, h = np.random.default_rng(seed), len(x), int(np.ceil(len(x) * share))
    floor = np.array(list(quality.STATS.values())) ** 2
    grow = share / chi2(CHI6_75, 4) if share == 0.75 else 1

    def fit(rows, grow):
        w = len(rows) / (len(rows) + quality.SHRINK)
        c = np.cov(rows.T, bias=True) * grow * w + np.diag(typical**2) * (1 - w)
        np.fill_diagonal(c, np.maximum(np.diag(c), floor))
        return rows.mean(axis=0), c

    def far(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    best = None
    for _ in range(trials):
        core = rng.choice(n, x.shape[1] + 1, replace=False)
        for _ in range(100):
            m, c = fit(x[core], grow)
            new = np.argsort(far(m, c), kind="stable")[:h]
            if set(new) == set(core):
                break
            core = new
        det = np.linalg.slogdet(c)[1]
        if best is None or det < best[0]:
            best = det, m, c
    inner = x[far(best[1], best[2]) <= CHI6_975]
    return best[0], far(*fit(inner, 0.975 / chi2(CHI6_975, 4)))


#: Quantiles of chi-square with six degrees of freedom, from printed tables.
CHI6_75, CHI6_975, CHI6_999 = 7.841, 14.449, 22.458


def chi2(x, half):
    """The share of chi-square with 2 * half degrees of freedom up to x."""
    return 1 - np.exp(-x / 2) * sum((x / 2) ** i / np.prod(range(1, i + 1)) for i in range(half))


def test_chi_square():
    assert abs(quality.chi_quantile(0.75, 6) - CHI6_75) < 1e-3 and abs(quality.chi_quantile(0.975, 6) - CHI6_975) < 1e-3
    assert abs(quality.chi_quantile(0.999, 6) - CHI6_999) < 1e-3 and abs(quality.LIMIT - CHI6_999) < 1e-2


def test_least_determinant(spark):
    """Against many random starts in numpy: no larger determinant, close distances, equal verdicts."""
    rows = [(i, t, "en", "a") for i, t, *_ in clean()]
    ids, x = fitted(spark, rows)
    step = 0.01
    mid = [np.sort(np.floor(c / step + 1e-9))[int(np.ceil(len(c) / 2)) - 1] * step + step / 2 for c in x.T]
    off = [np.sort(np.floor(np.abs(c - m) / step + 1e-9))[int(np.ceil(len(c) / 2)) - 1] * step + step / 2 for c, m in zip(x.T, mid)]
    typical = np.maximum(1.4826 * np.array(off), list(quality.STATS.values()))
    det, d2 = least_determinant(x, typical, 0.75)
    names = list(quality.STATS)
    vectors = spark.createDataFrame([("p", *(int(round(v * quality.POINT)) for v in r)) for r in x], ["pool", *names])
    assert quality.estimate(vectors, names).first()["log_det"] <= det + 0.05
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, rows)).collect() if not r["base_failed"]}
    assert sorted(got) == ids
    assert max(abs(got[i]["d2"] - w) / (1 + w) for i, w in zip(ids, d2)) < 0.1
    assert all(got[i]["kept"] == (w <= quality.LIMIT) for i, w in zip(ids, d2) if abs(w - quality.LIMIT) > 2)


def test_groups_of_any_size(spark):
    """Each language and source has an estimate of its own, whatever its size: a group of symbols alone is at home."""
    symbols = [(t[0], t[1], "xx", "z") for t in clean()[260:]]
    one = [(900, words(random.Random(4), 50), "yy", None)]
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, clean()[:260] + symbols + one)).collect()}
    assert all(r["kept"] and r["d2"] is not None for r in got.values())
    assert got[900]["d2"] < 1e-6


def test_empty(spark):
    assert quality.judged(empty(spark)).count() == 0
