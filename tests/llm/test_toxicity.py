import itertools
import random

import numpy as np

from sparkfed.llm import toxicity

from .helpers import empty, frame, odd_documents, words


def test_marginals_by_enumeration():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5):
        s, moves = rng.normal(0, 1.5, n), tuple(rng.normal(0, 1, 3))
        weight = np.zeros(n)
        total = 0.0
        for y in itertools.product((0, 1), repeat=n):
            p = sum(s[i] for i in range(n) if y[i]) + sum({(0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}.get(z, 0.0) for z in zip(y, y[1:]))
            total += np.exp(p)
            weight += np.exp(p) * np.array(y)
        both = np.concatenate((s, s[:1]))
        got = toxicity.marginals(both, np.array([n, 1]), moves)
        assert np.allclose(got[:n], weight / total)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < 0.3
        text = words(rng, rng.randint(5, 60)).split()
        for _ in range(rng.randint(1, 3) * bad):
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "rotten", "grimfoul", "grimmest"]))
        out.append((i, " ".join(text), "en", "a", int(bad)))
    return out


def test_held_out_accuracy_and_spans(spark):
    data = corpus()
    docs = frame(spark, [r[:4] for r in data])
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in data] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, usable=labels["doc_id"] % 3 != 0)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [r for r in data if r[0] % 3 == 0]
    assert np.mean([(got[i]["toxic_score"] >= 0.5) == bool(y) for i, *_, y in held]) > 0.95
    found = [t[s["start"] : s["end"]] for i, t, *_ in held for s in got[i]["toxic_spans"]]
    assert found and np.mean([any(w in x for w in ("vile", "rotten", "grim")) for x in found]) > 0.9


def test_odd_rows(spark):
    rows = odd_documents()
    model = toxicity.fit([r[1] for r in corpus()], [r[4] for r in corpus()], [1.0] * 300)
    out = toxicity.score(frame(spark, rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r["toxic_score"] <= 1 for r in out)
    assert len({r["toxic_score"] for r in out if not (r["text"] or "").strip()}) == 1
    assert toxicity.score(empty(spark), model).count() == 0


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, odd_documents()), labels)
    assert all(r["toxic_score"] < 0.5 for r in toxicity.score(frame(spark, odd_documents()), model).collect())


def test_spans_where_lower_case_splits_words(spark):
    """A dotted capital I becomes two words when the whole text is lowered; the spans stay."""
    model = toxicity.fit([r[1] for r in corpus()], [r[4] for r in corpus()], [1.0] * 300)
    text = "İstanbul abc dee vile Rotten GRIMFOUL abe"
    (row,) = toxicity.score(frame(spark, [(1, text, "en", "a")]), model).collect()
    found = " ".join(text[s["start"] : s["end"]] for s in row["toxic_spans"])
    assert all(w in found for w in ("vile", "Rotten", "GRIMFOUL")) and "İstanbul" not in found


def test_rare_words_are_no_tags():
    """Among very many rare words some occur in toxic texts alone by chance; texts that the fit did not see tell."""
    rng = random.Random(6)
    rare = ["".join(rng.choices("abcdefghijklmnopqrstuvw", k=9)) for _ in range(33_000)]
    bad = ["z" + "".join(rng.choices("abcdef", k=7)) for _ in range(10)]

    def text(toxic):
        return " ".join(rng.sample(rng.choices(rare, k=200) + rng.choices(bad, k=3 * toxic), 200 + 3 * toxic))

    y = [int(i % 5 < 2) for i in range(1000)]
    rng.shuffle(y)
    model = toxicity.fit([text(t) for t in y], y, [1.0] * len(y))
    clean = toxicity.score_batch([text(0) for _ in range(300)], model, False)[0]
    toxic = toxicity.score_batch([text(1) for _ in range(300)], model, False)[0]
    assert np.mean(np.array(clean) < 0.5) > 0.98 and np.mean(np.array(toxic) >= 0.5) > 0.95
