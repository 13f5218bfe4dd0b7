"""Each query's contract columns against plain Python written from the contract, over a small folder with odd rows."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from sparkfed.llm import queries

SF = "/root/testdata/sf0.001"
GPL = "This is free software under the GNU General Public License. See the MIT  license, or CC-BY; the apache license."
ODD = [None, "", " \n\t ", "one", "x <|endoftext|> y", "İstanbul ÀÉ ünï code 漢字 🎉", GPL, "w " * 5000, "same line\nsame line\n\nsame line ", "a b c d e f g h i a b c d e f g h i"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    odd = pd.DataFrame({"doc_id": range(10**6, 10**6 + len(ODD)), "text": ODD, "lang": ["en", None] * 5, "source": "odd", "n_chars": [len(t or "") for t in ODD]})
    pd.concat([docs, odd], ignore_index=True).to_parquet(at / "documents.parquet")
    for name in ("embeddings", "labels"):
        pd.read_parquet(f"{SF}/{name}.parquet").to_parquet(at / f"{name}.parquet")
    return str(at)


@pytest.fixture(scope="module")
def texts(folder):
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    return {i: t or "" for i, t in zip(docs["doc_id"].tolist(), docs["text"].tolist())}


def run(spark, folder, name):
    return queries.queries()[name](spark, folder).collect()


def by_doc(rows, texts):
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    return {r["doc_id"]: r for r in rows}


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op1(spark, folder, texts):
    got = by_doc(run(spark, folder, "op1_brown_class_ngrams"), texts)
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if remainder(i, 10) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (remainder(i, 10) == 0, len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_op2(spark, folder, texts):
    got = by_doc(run(spark, folder, "op2_simhash_near_dedup"), texts)
    prints = {}
    for i, t in texts.items():
        ws = WORD.findall(t.translate(LOWER))
        shingles = [" ".join(ws[j : j + 4]) for j in range(max(1, len(ws) - 3))] if ws else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in texts}
    ids = sorted(texts)
    for _ in ids:
        before = dict(root)
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{prints[i]:016x}", root[i]) for i in ids}


def test_op3(spark, folder):
    d = pd.read_parquet(f"{folder}/embeddings.parquet")
    x, ids = np.stack(d["embedding"].to_numpy()).astype(np.float64), d["vec_id"].to_numpy()
    found = {}
    for r in run(spark, folder, "op3_hash_prefix_forest"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 100 == 0)
    hits, place = 0, {i: n for n, i in enumerate(ids.tolist())}
    for q, rows in found.items():
        rows.sort()
        far = np.sqrt(((x - x[place[q]]) ** 2).sum(axis=1))
        best = [i for _, i in sorted((f, i) for f, i in zip(far.tolist(), ids.tolist()) if i != q)[:10]]
        assert [r[0] for r in rows] == list(range(1, 11)) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)
        assert all(math.isclose(s, far[place[i]], rel_tol=1e-12) for _, s, i in rows)
        hits += len({r[2] for r in rows} & set(best))
    assert hits >= 0.9 * 10 * len(found)


def test_op4(spark, folder, texts):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows, pieces, sequences = run(spark, folder, "op4_best_fit_packing"), {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(pieces) == sorted(texts)
    for i, t in texts.items():
        ids, at = [*tokenizer.encode(t, add_special_tokens=False).ids, 2], 0
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert len(own) == -(-len(ids) // 1024)
        for n, r in enumerate(own):
            assert (r["piece"], r["start"]) == (n, at) and (n == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *ids[at : at + r["length"]]))
            at += r["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_op6(spark, folder, texts):
    import base64

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_doc(run(spark, folder, "op6_bpe_round_trip"), texts)
    for i, t in texts.items():
        ids = coder.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_op7(spark, folder, texts):
    got, seen = by_doc(run(spark, folder, "op7_suffix_dedup"), texts), set()
    for i in sorted(texts):
        b = texts[i].encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(b[s : s + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())


def test_op8(spark, folder, texts):
    got = by_doc(run(spark, folder, "op8_quality_rules"), texts)
    for i, t in texts.items():
        ws, lines = WORD.findall(t), [line for line in t.split("\n") if WORD.search(line)]
        windows = [tuple(ws[j : j + 8]) for j in range(len(ws) - 7)]
        often = Counter(windows)
        covered = {k for j, w in enumerate(windows) if often[w] > 1 for k in range(j, j + 8)}
        r = got[i]
        base = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0]) and not (r["base_failed"] and r["kept"])


def test_op9(spark, folder, texts):
    """Also: the labels of held-out documents change nothing."""
    got = by_doc(run(spark, folder, "op9_toxicity_crf"), texts)
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    for i, r in got.items():
        assert r["held_out"] == (remainder(i, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = labels["doc_id"].map(lambda i: remainder(i, 5) == 0)
    labels.assign(toxic=labels["toxic"].where(~held, 1 - labels["toxic"])).to_parquet(f"{folder}/labels.parquet")
    again = by_doc(run(spark, folder, "op9_toxicity_crf"), texts)
    labels.to_parquet(f"{folder}/labels.parquet")
    assert all(math.isclose(again[i]["score"], r["score"], abs_tol=1e-9) for i, r in got.items())


def test_op9_held_out_accuracy(spark):
    """825 held-out labels, 97 of them toxic; the 68 labels that the small folder trains on are too few for the threshold."""
    sf = SF.replace("0.001", "0.1")
    got = {r["doc_id"]: r["predicted"] for r in run(spark, sf, "op9_toxicity_crf") if r["held_out"]}
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    toxic = [(y, got[i]) for i, y in zip(labels["doc_id"].tolist(), labels["toxic"].tolist()) if i in got]
    assert sum(y == p for y, p in toxic) >= 0.97 * len(toxic)
    assert sum(p for y, p in toxic if y) >= 0.85 * sum(y for y, _ in toxic)


def test_op10(spark, folder, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = by_doc(run(spark, folder, "op10_license_scan"), texts)
    for i, t in texts.items():
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
        at = {p: [j for j in range(len(ws)) if ws[j : j + len(p.split())] == p.split()] for p in phrases}
        places, base = sorted(sum(at.values(), [])), sorted(phrases[p] for p, js in at.items() if js)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(ws), len(places), ",".join(base))
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        own = r["labels"].split(",") if r["labels"] else []
        assert own == sorted(set(own)) and set(base) <= set(own) and 0 <= r["score"] <= 1
    assert got[10**6 + 6]["n_base"] == 4
