"""run() against plain Python on planted toxic words, near lines, near copies and repeated passages."""

import random

import corpus_pipeline
from sparkfed.llm import packing, queries

from .test_line_dedup import one_edit
from .test_suffix_dedup import brute as cut


def fixture():
    """(doc_id, text), and the ids of toxic documents."""
    rng = random.Random(3)
    line = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts, toxic = [], set()
    for g in range(30):
        own = line(120)
        texts.append(" ".join(own))
        for edits in (2, 2, 3):
            copy = list(own)
            for at in rng.sample(range(120), edits):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
        short = line(10)
        texts.append("\n".join([" ".join(short), " ".join(line(30))]))
        texts.append("\n".join([" ".join(line(30)), " ".join(short[:4] + ["new"] + short[5:])]))
        passage = " ".join(line(25))
        texts += [" ".join([*line(20), passage, *line(20)]) for _ in range(2)]
    for _ in range(60):
        at = rng.randrange(len(texts) + 1)
        texts.insert(at, " ".join(w for x in line(20) for w in (x, rng.choice(["vile", "rotten", "grimfoul"]))))
    toxic = {i for i, t in enumerate(texts) if "vile" in t or "rotten" in t}
    return list(enumerate(texts)), toxic


def plain(docs, toxic):
    docs = {i: t for i, t in docs if i not in toxic}
    seen, kept = [], {}
    for i, t in sorted(docs.items()):
        stay = []
        for x in t.split("\n"):
            w = x.split()
            if not any(w == o or (len(w) >= 8 and len(o) >= 8 and one_edit(o, w)) for o in seen):
                stay.append(x)
            seen.append(w)
        kept[i] = "\n".join(stay)
    ids, sets = sorted(kept), {}
    for i in ids:
        w = kept[i].split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    left = {i: kept[i] for i in ids if root[i] == i}
    return kept, left, {i: x[3].decode() for i, x in cut(left, 100).items()}


def test_against_brute_force(spark, tmp_path):
    docs, toxic = fixture()
    kept, left, want = plain(docs, toxic)
    assert len(left) < len(kept) - 50 and any(kept[i] != t for i, t in docs if i in kept) and any(want[i] != left[i] for i in left)
    spark.createDataFrame([(i, t, "en", "a") for i, t in docs], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, str(tmp_path)).select(*key)
    frame = spark.createDataFrame([(i, t, "en", "a") for i, t in want.items()], "doc_id long, text string, lang string, source string")
    packed = packing.pack(frame, queries.vocabulary("byte_bpe_50k.json")).select(*key)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, packed.collect()))
