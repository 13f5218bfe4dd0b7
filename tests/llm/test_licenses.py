import re

from sparkfed.llm import licenses

from .helpers import empty, frame, odd_documents

TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "MIT License mit license", "the Apache License, Version 2.0; see apache.org/licenses/LICENSE-2.0",
    "gnu lesser general public license version 2.1 or bsd 3-clause license", "SPDX-License-Identifier: GPL-2.0-or-later", "permit the mitten", "under the MIT", "all rights reserved. Copyright (c) 2001",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "cc\nby cc-by\tcc by sa 4.0", "épi mit\x00license", "mozilla public license 2.0 " * 400,
]


def brute(text):
    low = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += own
        base |= {label} if own else set()
    joined = f" {' '.join(w)} "
    kept, taken = [], set()  # by characters: a rule's match stays if no more important rule's match holds one of them
    for label, s, _, p in licenses.rules():
        for m in re.finditer(p, joined):
            own = set(range(*m.span()))
            if not own & taken:
                taken |= own
                kept.append((label, s))
    score = max([s for _, s in kept] + [licenses.PHRASE_SCORE] * bool(base), default=0.0)
    return len(w), sorted(places), sorted(base | {x for x, _ in kept}), score


def test_scan(spark):
    rows = odd_documents() + [(5000 + i, t, "en", "a") for i, t in enumerate(TEXTS)]
    got = licenses.scan(frame(spark, rows)).collect()
    own = sorted((str(r["doc_id"]), r["n_words"], sorted(x for p in r["phrase_places"] for x in p), list(r["labels"]), r["score"]) for r in got)
    assert own == sorted((str(r[0]), *brute(r[1])) for r in rows)


def test_labels():
    assert brute(TEXTS[0])[2] == ["gpl", "gpl-3.0", "terms-notice"] and brute(TEXTS[6])[2] == [] and "lgpl-2.1" in brute(TEXTS[4])[2]


def test_many_rules():
    assert len(licenses.rules()) >= 200
    for _, _, keyword, pattern in licenses.rules():
        re.compile(pattern)
        assert keyword == keyword.lower()


def test_any_of():
    names = ["apache", "apple", "app", "bsd", "b"]
    assert all(re.fullmatch(licenses.any_of(names), w) for w in ("app", "b")) and not re.fullmatch(licenses.any_of(names), "ap")


def test_empty(spark):
    assert licenses.scan(empty(spark)).count() == 0


def expansions(pattern):
    """Texts of a rule's pattern: every alternative, optional part and character of a set (a few of long ones)."""
    from re import _parser

    def seq(items):
        out = [""]
        for op, arg in items:
            out = [a + b for a in out for b in one(str(op), arg)]
        return out

    def one(op, arg):
        if op == "LITERAL":
            return [chr(arg)]
        if op == "BRANCH":
            return [x for branch in arg[1] for x in seq(branch)]
        if op == "SUBPATTERN":
            return seq(arg[3])
        if op == "MAX_REPEAT":
            low, high, body = arg
            return [x * n for n in {low, min(int(high), low + 1)} for x in seq(body)]
        if op == "IN":
            out = []
            for kind, x in arg:
                out += [chr(x)] if str(kind) == "LITERAL" else ["7"] if str(kind) == "CATEGORY" else [chr(x[0]), chr(x[1])]
            return out
        assert op == "ASSERT", op
        return [""]

    return seq(_parser.parse(pattern))


def test_keywords_are_implied():
    """Whatever a rule matches holds its keyword at a word's start."""
    for label, _, keyword, pattern in licenses.rules():
        for text in expansions(pattern):
            assert re.search(pattern, f" {text} ") and f" {keyword}" in f" {text}", (label, keyword, text)


def test_scan_equals_all_rules(spark):
    """Texts that hold a rule's match and nothing else get what all rules without a prefilter give."""
    texts = sorted({x for *_, p in licenses.rules() for x in expansions(p)[:: max(1, len(expansions(p)) // 4)]} | {"0BSD", "ASL 2.0", "license file", "Berkeley Software Distribution", "unlicence"})
    got = {r["doc_id"]: (list(r["labels"]), r["score"]) for r in licenses.scan(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t)[2:], t


def test_priority(spark):
    """Notices as they are commonly written, and detections that do not overlap."""
    notice = "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    texts = [notice, notice.replace("version 2", "version 3"), "the Apache License, Version 2.0", "GNU General Public License version 2"]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    label = lambda i: {d["label"] for d in got[i]["detections"]}
    assert "gpl-2.0-or-later" in label(0) and "gpl-2.0" not in label(0) and "gpl-3.0-or-later" in label(1)
    assert label(2) == {"apache-2.0"} and label(3) == {"gpl-2.0"}
    for r in got.values():
        assert all(a["end"] <= b["start"] for a, b in zip(r["detections"], r["detections"][1:]))
