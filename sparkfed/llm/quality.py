"""Robust multivariate outliers among texts, in DataFrame functions alone.

Every text has a vector of transformed statistics. For each language and source the minimum-covariance-determinant
estimate is sought as deterministic MCD does: from several robust starts, each concentrated until its determinant falls
no more (distances, the share CORE of rows with the smallest, their mean and covariance, again); the least determinant
of a group wins, and is then reweighted by the rows within the 0.975 quantile. The starts share the medians and have as
their shape: none (scales alone), the spatial signs, the hyperbolic tangents, and the half of rows nearest the medians.
Covariances are regularised by the scales of all rows as if SHRINK more rows had those, so that a group of any size,
down to one row, has an estimate of its own.

Sums run over fixed-point whole numbers and the cut-off of a step is read from a histogram of distances with a bounded
number of bins, so results do not depend on the order of rows, and no group is gathered anywhere. Texts that fail fixed
rules are neither fitted nor kept; the others are rejected if their Mahalanobis distance exceeds LIMIT.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free, materialise

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
CORE = 0.75
#: Rows of typical scale that a group's covariance counts beside its own.
SHRINK = 20
#: Fall of a log determinant under which a step has converged; the distances' bins are no finer.
SETTLED = 1e-3
#: Fits that are broadcast, a row of at most 30 numbers each; more of them are joined by a shuffle.
HELD = 20_000
#: Squared distance over which a text is rejected: the 0.999 quantile of chi-square with six degrees of freedom.
LIMIT = 22.46
#: Least standard deviation of each statistic, so that constant ones (no symbols at all) do not make all else an outlier.
STATS = {"x_length": 0.8, "x_word": 0.5, "x_symbol": 0.08, "x_punct": 0.06, "x_upper": 0.06, "x_repeat": 0.2}
#: Fixed point of the statistics in sums, and bins of a distance's square root in histograms.
POINT, BIN = 10_000, 50


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_punct and n_upper of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("_words", F.array_remove(F.split(text, SPACE), ""))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", (F.length(text) - F.regexp_count(text, F.lit(SPACE[:-1]))).cast("long"))
    df = df.withColumn("n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
    df = df.withColumn("n_punct", F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]")).cast("long"))
    df = df.withColumn("n_upper", F.regexp_count(text, F.lit("[A-Z]")).cast("long"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # Hashes of 8-word windows by doubling: of 1 + 1, 2 + 2 and 4 + 4 words. zip_with pads with nulls, cut off at the end.
    double = lambda a, k: F.zip_with(a, F.slice(a, F.lit(k + 1), F.greatest(F.size(a), F.lit(1))), lambda x, y: F.xxhash64(x, y))
    long_enough = F.size("_words") >= WINDOW
    df = df.withColumn("_w", F.when(long_enough, double(F.col("_words"), 1)))
    df = df.withColumn("_w", double(F.col("_w"), 2))
    df = df.withColumn("_w", F.slice(double(F.col("_w"), 4), F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))))
    df = df.withColumn("_w", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), F.col("_w")))
    # Equal windows are neighbours when sorted; of the positions of repeated ones, each covers up to the next one.
    placed = F.array_sort(F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("_w", placed)
    beside = lambda x, j: F.coalesce(x["h"] == F.get(F.col("_w"), j)["h"], F.lit(False))
    again = F.filter("_w", lambda x, j: beside(x, j - 1) | beside(x, j + 1))
    df = df.withColumn("_at", F.array_sort(F.transform(again, lambda x: x["i"])))
    gaps = F.transform("_at", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), j + 1) - x, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.drop("_words", "_lines", "_w", "_at")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector(df: DataFrame) -> DataFrame:
    """The transformed statistics, as whole numbers of 1 / POINT."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    n = F.greatest(F.col("n_words"), F.lit(1))
    of = {
        "x_length": F.log1p("n_words"),
        "x_word": F.sqrt(F.col("word_chars") / n),
        "x_symbol": F.sqrt(F.col("n_symbols") / chars),
        "x_punct": F.sqrt(F.col("n_punct") / chars),
        "x_upper": F.sqrt(F.col("n_upper") / chars),
        "x_repeat": F.sqrt((F.col("n_repeat_words") + 0.0) / n),
    }
    return df.withColumns({k: F.round(v * POINT).cast("long") for k, v in of.items()})


def chi_share(x: float, k: int) -> float:
    """Share of a chi-square distribution with an even number k of degrees of freedom up to x."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def chi_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_share(mid, k) < share else (low, mid)
    return high


def consistency(share: float, k: int) -> float:
    """What the covariance of a normal sample's innermost share is to be multiplied by."""
    return share / chi_share(chi_quantile(share, k), k + 2) if share < 1 else 1.0


def with_fits(rows: DataFrame, fits: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """rows joined with written fits: a broadcast while they are few, counted before."""
    return rows.join(F.broadcast(fits) if fits.count() <= HELD else fits, on, how)


def factor(fit: DataFrame, keys: list[str], k: int) -> DataFrame:
    """A fit with its Cholesky factor's columns l_i_j in place of c_i_j, built up column by column, and log_det."""
    for j in range(k):
        for i in range(j, k):
            rest = F.col(f"c_{i}_{j}") - reduce(lambda a, b: a + b, [F.col(f"l_{i}_{p}") * F.col(f"l_{j}_{p}") for p in range(j)], F.lit(0.0))
            fit = fit.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
    log_det = reduce(lambda a, b: a + b, [2 * F.log(f"l_{i}_{i}") for i in range(k)])
    return fit.select(*keys, *(f"m_{i}" for i in range(k)), *(f"l_{i}_{j}" for i in range(k) for j in range(i + 1)), log_det.alias("log_det"))


def distance(joined: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """keep and d2, for rows beside a factored fit."""
    k = len(names)
    for i in range(k):
        rest = (F.col(names[i]) / POINT - F.col(f"m_{i}")) - reduce(lambda a, b: a + b, [F.col(f"l_{i}_{p}") * F.col(f"z_{p}") for p in range(i)], F.lit(0.0))
        joined = joined.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(k)])
    return joined.withColumn("d2", d2).select(*keep, "d2")


def bin_of(d2: Column | str) -> Column:
    return F.floor(F.sqrt(F.least(d2, F.lit(1e6))) * BIN)


def below(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """keys and bin: the smallest bin up to which at least the share of a key's rows lies."""
    bins = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*keys)
    run = bins.withColumn("up", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    return run.where(F.col("up") >= F.col("all") * share).groupBy(*keys).agg(F.min("bin").alias("bin"))


def sums(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys, n, means m_i and covariances c_i_j of each key, over exact whole-number sums."""
    k = len(names)
    whole = lambda c: F.sum(c.cast("decimal(38,0)")).cast("double")
    of = [F.count(F.lit(1)).alias("n")]
    of += [whole(F.col(names[i])).alias(f"s_{i}") for i in range(k)]
    of += [whole(F.col(names[i]) * F.col(names[j])).alias(f"q_{i}_{j}") for i in range(k) for j in range(i + 1)]
    mean = {f"m_{i}": F.col(f"s_{i}") / F.col("n") / POINT for i in range(k)}
    cov = {f"c_{i}_{j}": (F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"s_{i}") / F.col("n") * F.col(f"s_{j}") / F.col("n")) / POINT**2 for i in range(k) for j in range(i + 1)}
    return rows.groupBy(*keys).agg(*of).select(*keys, "n", *(v.alias(a) for a, v in (mean | cov).items()))


def regular(found: DataFrame, keys: list[str], typical: list[float], grow: float) -> DataFrame:
    """The factored fits of sums(): covariances grown to consistency, drawn to the typical scales by SHRINK rows, and no
    variance under its floor."""
    k, floor = len(typical), list(STATS.values())
    weight = F.col("n") / (F.col("n") + SHRINK)
    cov = {}
    for i in range(k):
        for j in range(i + 1):
            c = F.col(f"c_{i}_{j}") * grow * weight
            cov[f"c_{i}_{j}"] = F.greatest(c + F.lit(typical[i] ** 2) * (1 - weight), F.lit(floor[i] ** 2)) if i == j else c
    return factor(found.withColumns(cov), keys, k)


def scales(rows: DataFrame, names: list[str]) -> DataFrame:
    """pool, medians m_i and standard deviations s_i from the median absolute deviations, none under its floor; from
    histograms in hundredths, of some thousands of bins for each pool."""
    step = POINT // 100
    values = rows.select("pool", F.posexplode(F.array(*names)).alias("i", "v"))
    centre = (F.col("bin") * step + step // 2).alias("mid")
    mid = materialise(below(values.withColumn("bin", F.floor(F.col("v") / step)), ["pool", "i"], 0.5).select("pool", "i", centre))
    off = with_fits(values, mid, ["pool", "i"]).select("pool", "i", F.floor(F.abs(F.col("v") - F.col("mid")) / step).alias("bin"))
    mad = below(off, ["pool", "i"], 0.5).select("pool", "i", centre.alias("mad"))
    at = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c))) / POINT
    floor = list(STATS.values())
    out = [at("mid", i).alias(f"m_{i}") for i in range(len(names))]
    out += [F.greatest(1.4826 * at("mad", i), F.lit(floor[i])).alias(f"s_{i}") for i in range(len(names))]
    return mid.join(mad, ["pool", "i"]).groupBy("pool").agg(*out)


def starts(rows: DataFrame, names: list[str]) -> DataFrame:
    """The factored starts of each pool, (pool, start): medians, and one shape each, scaled by the deviations."""
    k = len(names)
    mid = materialise(scales(rows, names))
    z = [(F.col(names[i]) / POINT - F.col(f"m_{i}")) / F.col(f"s_{i}") for i in range(k)]
    norm = F.sqrt(reduce(lambda a, b: a + b, [x * x for x in z]))
    tanh = [F.tanh(x) for x in z]
    half = materialise(below(with_fits(rows, mid, ["pool"]).select("pool", bin_of(norm * norm).alias("bin")), ["pool"], 0.5).withColumnRenamed("bin", "half"))
    beside = with_fits(with_fits(rows, mid, ["pool"]), half, ["pool"]).withColumn("_norm", norm)
    sign = [x / F.greatest(F.col("_norm"), F.lit(1e-9)) for x in z]
    near = bin_of(F.col("_norm") * F.col("_norm")) <= F.col("half")
    whole = lambda start, xs: F.struct(F.lit(start).alias("start"), *(F.round(x * POINT).cast("long").alias(f"w_{i}") for i, x in enumerate(xs)))
    # Far values would only matter in the shape of the near half, which has none.
    each = F.array_compact(F.array(whole(1, sign), whole(2, tanh), F.when(near, whole(3, [F.greatest(F.least(x, F.lit(1e3)), F.lit(-1e3)) for x in z]))))
    shape = sums(beside.select("pool", F.explode(each).alias("w")).select("pool", "w.*"), ["pool", "start"], [f"w_{i}" for i in range(k)])
    wide = [F.greatest(F.col(f"c_{i}_{i}"), F.lit(1e-6)) for i in range(k)]
    r = {f"r_{i}_{j}": F.col(f"c_{i}_{j}") / F.sqrt(wide[i] * wide[j]) for i in range(k) for j in range(i)}
    shape = shape.select("pool", "start", *(v.alias(a) for a, v in r.items()))
    plain = mid.select("pool", F.lit(0).alias("start"), *(F.lit(0.0).alias(a) for a in r))
    s = lambda i: F.col(f"s_{i}")
    cov = [(s(i) * s(i) if i == j else F.col(f"r_{i}_{j}") * s(i) * s(j)).alias(f"c_{i}_{j}") for i in range(k) for j in range(i + 1)]
    all_ = shape.unionByName(plain).join(mid, "pool").select("pool", "start", *(f"m_{i}" for i in range(k)), *cov)
    return factor(all_, ["pool", "start"], k)


def estimate(rows: DataFrame, names: list[str], core: float = CORE) -> DataFrame:
    """The reweighted fit of each pool's rows (pool and whole numbers of 1 / POINT), with the log_det of its core.

    Every start takes its own number of steps: one whose determinant has fallen by less than SETTLED takes no more. As
    a determinant falls by that much each time and the floors bound it, all end."""
    k = len(names)
    keys = ["pool", "start"]
    one = scales(rows.withColumn("pool", F.lit("*")), names).first()
    typical = [one[f"s_{i}"] for i in range(k)] if one else list(STATS.values())
    active = materialise(starts(rows, names).withColumn("log_det", F.lit(float("inf"))))
    best = None
    while best is None or active.count():
        near = distance(with_fits(rows, active, ["pool"]), names, [*keys, *names]).withColumn("bin", bin_of(F.col("d2")))
        cut = materialise(below(near, keys, core).withColumnRenamed("bin", "cut"))
        step = materialise(regular(sums(with_fits(near, cut, keys).where("bin <= cut"), keys, names), keys, typical, consistency(core, k)))
        was = active.select(*keys, F.col("log_det").alias("_was"))
        fit = [c for c in step.columns if c not in keys]
        seen = step if best is None else best.unionByName(step)
        least = F.min_by(F.struct("start", *fit), F.struct("log_det", "start")).alias("f")
        new_best = materialise(seen.groupBy("pool").agg(least).select("pool", "f.*").select(*step.columns))
        new_active = materialise(step.join(was, keys).where(F.col("log_det") < F.col("_was") - SETTLED).drop("_was"))
        free(active, cut, step, *([] if best is None else [best]))
        best, active = new_best, new_active
    inner = chi_quantile(0.975, k)
    weighed = distance(with_fits(rows, best, ["pool"]), names, ["pool", *names]).where(F.col("d2") <= inner)
    out = regular(sums(weighed, ["pool"], names), ["pool"], typical, consistency(0.975, k))
    return out.drop("log_det").join(best.select("pool", "log_det"), "pool")


def judged(docs: DataFrame, limit: float = LIMIT, core: float = CORE) -> DataFrame:
    """A row for each row of docs (doc_id, text, lang, source): the counts, base_failed, d2 and kept.

    Null text counts as empty (fails), null lang or source as ''. Repeated rows count each. Where no row of a language
    and source can be fitted, d2 is null. An empty table gives none. Very long texts are read whole."""
    names = list(STATS)
    rows = measured(docs.select("doc_id", "lang", "source", "text")).drop("text").withColumn("base_failed", base_failed())
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = materialise(vector(rows).withColumn("pool", F.to_json(F.array(text("lang"), text("source")))))
    fit = materialise(estimate(rows.where("not base_failed").select("pool", *names), names, core))
    out = distance(with_fits(rows, fit, ["pool"], "left"), names, rows.columns)
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(True))
    return out.withColumn("kept", kept)
