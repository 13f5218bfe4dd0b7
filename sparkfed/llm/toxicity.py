"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Fitting (on the driver, over a bounded sample): labels are given for documents, so tokens are labelled first: a token
of a toxic document is tagged when its word, or one of its prefixes, occurs in toxic texts and hardly in others. The
two-state chain has a weight for every word and prefix seen in three sampled texts or more, a bias and transitions; it
is fitted by gradient ascent, with gradients from forward-backward passes. A logistic function of the marginals'
sum and maximum turns them into a document's score; it is fitted on sampled texts that the chain did not see.

Scoring (in parallel, whole texts): forward and backward recursions run in step over the documents of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, give_back, worker_cache

WORD = r"[^\W_]+"
PREFIXES = (3, 4, 5, 6, 7)
#: The most labelled documents that a model is fitted on: toxic ones, and others.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 3000
SEGMENT = 512


@dataclass
class Model:
    weights: dict[int, float] = field(default_factory=dict)  # by a feature's 64-bit hash
    bias: float = -4.0
    moves: tuple[float, float, float] = (0.0, 0.0, 0.0)  # log weights of 0>1, 1>0 and 1>1
    line: tuple[float, ...] = (-2.0, 0.0, 0.0)  # of the document's score: constant, log1p of the sum, maximum
    key: str = ""


def lowered(text: str) -> list[str]:
    """The text's words, each in lower case by itself: as many as WORD finds in the text as it is."""
    return [w.lower() for w in re.findall(WORD, text)]


def features(word: str) -> list[int]:
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest("=" + word), *(xxh64_intdigest(word[:k]) for k in PREFIXES if len(word) >= k)]


def marginals(s, lengths, moves):
    """P(tag 1) of each token; s: log emissions of tag 1 against tag 0, documents one after another."""
    import numpy as np

    out = np.zeros(len(s))
    order = np.argsort(-lengths, kind="stable")
    off = (np.cumsum(lengths) - lengths)[order]
    n = lengths[order]
    if not len(s):
        return out
    e = np.exp(np.clip(s, -30, 30))
    t01, t10, t11 = np.exp(np.clip(moves, -30, 30))
    live = len(n) - np.searchsorted(n[::-1], np.arange(n[0]), side="right")  # documents longer than each step
    p = np.zeros(len(n))
    for t in range(n[0]):
        k = live[t]
        at, q = off[:k] + t, p[:k]
        one = ((1 - q) * t01 + q * t11) * e[at] if t else e[at]
        zero = (1 - q) + q * t10 if t else 1.0
        p[:k] = one / (one + zero)
        out[at] = p[:k]
    b = np.full(len(n), 0.5)  # share of tag 1 in the backward message
    for t in range(n[0] - 1, -1, -1):
        k = live[t]
        at, r = off[:k] + t, b[:k]
        f = out[at]
        out[at] = f * r / (f * r + (1 - f) * (1 - r))
        one, zero = (1 - r) + 0.0, r * e[at]  # messages to the token before: tag 0 and tag 1 here
        to0, to1 = one + zero * t01, one * t10 + zero * t11
        b[:k] = to1 / (to0 + to1)
    return out


def pair_expectations(s, lengths, moves, m):
    """Expected counts of 0>1, 1>0 and 1>1 by the chain rule over the marginals' forward messages."""
    import numpy as np

    t01, t10, t11 = np.exp(np.clip(moves, -30, 30))
    inner = np.ones(len(s), bool)
    inner[np.cumsum(lengths)[:-1]] = False
    inner[0] = False
    i = np.nonzero(inner)[0]
    # with both ends' marginals known, the pair is the 2x2 table with the chain's odds ratio
    ratio, out = t11 / (t01 * t10), np.zeros(3)
    for at in range(0, len(i), 200_000):
        a, b = m[i[at : at + 200_000] - 1], m[i[at : at + 200_000]]
        if abs(ratio - 1) < 1e-9:
            both = a * b
        else:
            c = 1 + (a + b) * (ratio - 1)
            both = (c - np.sqrt(np.maximum(c * c - 4 * ratio * (ratio - 1) * a * b, 0))) / (2 * (ratio - 1))
        out += ((b - both).sum(), (a - both).sum(), both.sum())
    return out


def fit(texts: list[str], toxic: list[int], weight: list[float], rounds: int = 30) -> Model:
    """A model from labelled texts, which are taken out of their list; weight: how many labelled rows each stands for.

    Without both labels present, the model gives every text the share of toxic rows."""
    import hashlib
    from array import array

    import numpy as np

    y = np.array(toxic, float)
    w = np.array(weight, float)
    share = float((y * w).sum() / max(w.sum(), 1e-9)) if len(y) else 0.0
    base = Model(line=(float(np.log((share + 1e-3) / (1 - share + 1e-3))), 0.0, 0.0))
    if len(y) < 10 or not 0 < y.sum() < len(y):
        return base
    index: dict[str, int] = {}
    docs = []
    while texts:  # emptied from its end, to hold each text once
        docs.append(np.array([index.setdefault(x, len(index)) for x in lowered(texts.pop())], np.int32))
    docs.reverse()
    per, hashes = [], array("Q")
    for x in index:
        own = features(x)
        per.append(len(own))
        hashes.extend(own)
    words = len(index)
    del index
    names, cols = np.unique(np.frombuffer(hashes, np.uint64), return_inverse=True)
    cols = cols.astype(np.int32)
    rows = np.repeat(np.arange(words, dtype=np.int32), per)
    starts = np.concatenate(([0], np.cumsum(per)))
    seen = np.zeros((2, len(names)))
    part = np.arange(len(docs)) % 4 != 3  # the last quarter is for the document's score: neither tags nor chain see it
    for d, lab in ((d, lab) for d, lab, use in zip(docs, toxic, part) if use):
        u = np.unique(d)
        f = np.unique(np.concatenate([cols[starts[i] : starts[i + 1]] for i in u])) if len(u) else u
        seen[int(lab), f] += 1
    total = np.array([(y[part] == 0).sum(), y[part].sum()])
    # tags: what toxic texts hold, in five of them at least, and others hardly, beyond what chance gives among so many
    odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 0.5) / (total[0] + 1))
    known = (seen[1] >= 5) & (odds >= 2.5) & (seen[1] * total[0] >= 8 * seen[0] * total[1])
    both, rate = np.maximum(seen.sum(0), 1), total / total.sum()
    surprise = sum(x * np.log(np.maximum(x, 1e-9) / np.maximum(both * r, 1e-9)) for x, r in zip(seen, rate))
    known &= surprise >= np.log(max(1, (seen.sum(0) >= 5).sum()))
    if not known.any():
        known = (seen[1] >= 2) & (odds >= 2.0)
    lively = seen.sum(0) >= 3
    tagged = np.bincount(rows, known[cols], words) > 0

    def emission(theta, bias):
        return np.bincount(rows, theta[cols], words) + bias

    pieces = [d[i : i + SEGMENT] for d, use in zip(docs, part) if use for i in range(0, len(d), SEGMENT)]
    tags = [tagged[d[i : i + SEGMENT]] & bool(lab) for d, use, lab in zip(docs, part, toxic) if use for i in range(0, len(d), SEGMENT)]
    if not pieces:
        return base
    flat, tag, lens = np.concatenate(pieces), np.concatenate(tags).astype(float), np.array([len(p) for p in pieces])
    theta, bias, moves = np.zeros(len(names)), -4.0, np.zeros(3)
    g_theta, g_rest = np.full(len(names), 1e-3), np.full(4, 1e-3)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(lens)[:-1]] = False
    inner[0] = False
    i = np.nonzero(inner)[0]
    a, b = tag[i - 1], tag[i]
    want = np.array([((1 - a) * b).sum(), (a * (1 - b)).sum(), (a * b).sum()])
    scale = max(1.0, tag.sum())
    for _ in range(rounds):
        s = emission(theta, bias)[flat]
        m = marginals(s, lens, moves)
        by_word = np.bincount(flat, tag - m, words)
        grad = (np.bincount(cols, by_word[rows], len(names)) - 0.05 * theta) * lively
        rest = np.append(want - pair_expectations(s, lens, moves, m), (tag - m).sum())
        g_theta += grad**2
        g_rest += (rest / scale) ** 2
        theta += 0.5 * grad / np.sqrt(g_theta)
        step = 0.3 * rest / scale / np.sqrt(g_rest)
        moves, bias = np.clip(moves + step[:3], -4, 4), bias + step[3]
    s = emission(theta, bias)
    x = []
    for d in (d for d, use in zip(docs, part) if not use):
        m = marginals(s[d], np.array([len(d)]), moves)
        x.append((1.0, np.log1p(m.sum()), m.max() if len(m) else 0.0))
    x, y2, w2 = np.array(x), y[~part], w[~part] / w.mean()
    line = np.array([base.line[0], 0.5, 0.5])
    for _ in range(25):  # Newton steps with a slight pull to zero
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        h = (x * (w2 * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        line = line + np.linalg.solve(h, x.T @ (w2 * (y2 - p)) - 0.1 * line)
    keep = np.nonzero(np.abs(theta) > 0.02)[0]
    model = Model({int(names[j]): float(theta[j]) for j in keep}, float(bias), tuple(map(float, moves)), tuple(map(float, line)))
    model.key = hashlib.md5(repr((sorted(model.weights.items()), model.bias, model.moves)).encode()).hexdigest()
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Fits on at most `toxic` and `clean` labelled documents of each kind, chosen by a hash of their id.

    usable: which rows of labels may be learned from. Rows of labels with nulls are left out; of several for one
    document the most toxic counts; equal texts count once."""
    rows = labels.where("doc_id is not null and toxic is not null")
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pick = lambda lab, most: rows.where(F.col("toxic") == lab).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = pick(1, toxic).union(pick(0, clean))  # bounded by the two parameters
    got = docs.select("doc_id", "text").where("doc_id is not null").join(F.broadcast(chosen), "doc_id")
    got = got.toPandas().sort_values(["doc_id", "text"]).drop_duplicates(["text", "toxic"])
    got = got[got["text"].notna()]
    n = got["toxic"].value_counts().to_dict()
    got = got.iloc[[i for _, i in sorted((hash_of(d), i) for i, d in enumerate(got["doc_id"]))]]
    texts, toxic_ = got["text"].tolist(), got["toxic"].tolist()
    del got
    give_back()
    model = fit(texts, toxic_, [total[t] / n[t] for t in toxic_])
    give_back()
    return model


def hash_of(x: object) -> int:
    import zlib

    return zlib.crc32(str(x).encode()) * 2654435761 % 2**32


class Emissions(dict):
    """word -> log emission; computed once for each word that a worker meets."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 200_000:
            self.clear()
        get = self.model.weights.get
        s = self[word] = self.model.bias + sum(get(f, 0.0) for f in features(word))
        return s


def score_batch(texts: list[str], model: Model, spans: bool) -> tuple[list[float], list[list[dict]]]:
    import numpy as np

    kept = worker_cache("toxicity")
    if model.key not in kept:
        kept.clear()
        kept[model.key] = Emissions(model)
    of = kept[model.key].__getitem__
    parts = [np.fromiter(map(of, lowered(t)), np.float64) for t in texts]
    lens = np.array([len(p) for p in parts], np.int64)
    m = marginals(np.concatenate(parts) if parts else np.zeros(0), lens, model.moves)
    scores, found = [], []
    at = 0
    for t, n in zip(texts, lens.tolist()):
        own = m[at : at + n]
        at += n
        z = model.line[0] + model.line[1] * np.log1p(own.sum()) + model.line[2] * (own.max() if n else 0.0)
        scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        runs: list[dict] = []
        if spans and n and own.max() >= 0.5:
            # Offsets are of the text itself; lower-casing can change a text's length.
            words = list(re.finditer(WORD, t))
            for i in np.nonzero(own >= 0.5)[0].tolist():
                if runs and runs[-1]["last"] == i - 1:
                    runs[-1] |= {"end": words[i].end(), "last": i, "p": max(runs[-1]["p"], float(own[i]))}
                else:
                    runs.append({"start": words[i].start(), "end": words[i].end(), "last": i, "p": float(own[i])})
        found.append([{"start": r["start"], "end": r["end"], "p": r["p"]} for r in runs])
    return scores, found


def score(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """docs with toxic_score (0 to 1) and, if asked for, toxic_spans: character offsets and the highest marginal.

    Null and empty texts get the score of no tokens. Rows are scored alone, so ties and repeated rows change nothing; a
    very long text is held as a few numbers for each of its words. An empty table gives no rows. Columns named like the
    two results are replaced."""
    import pandas as pd
    from pyspark.sql import types as T

    added = [T.StructField("toxic_score", T.DoubleType())]
    if spans:
        added.append(T.StructField("toxic_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())]))))
    names = {f.name for f in added}
    docs = docs.select(*(c for c in docs.columns if c not in names))
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for i in range(0, len(b), 2000):
                part = b.iloc[i : i + 2000]
                s, f = score_batch([t or "" for t in part["text"]], model, spans)
                new = {"toxic_score": s} | ({"toxic_spans": pd.Series(f, index=part.index, dtype=object)} if spans else {})
                yield part.assign(**new)
                give_back()

    return docs.mapInPandas(run, schema)


by_value(__name__)
