"""Small documents with every odd case: null and empty texts, null ids, repeated rows, long texts, clashing columns."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row long, kept string, h string, block int, line string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_documents(seed=1, n=60):
    """(doc_id, text, lang, source); ids are unique but for a repeated row and two nulls."""
    rng = random.Random(seed)
    base = [words(rng, 40) for _ in range(6)]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice(base) if rng.random() < 0.4 else words(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 4)))
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None])))
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, " \n\t ", None, None), (1003, "x " * 3000, "en", "a"), (1004, rows[3][1], "en", "b"), (1005, rows[3][1] + " tail", "en", "b")]
    rows += [rows[5], (None, "only a null id here", None, None), (None, None, None, None)]
    return rows


def frame(spark, rows):
    """The rows with columns whose names clash with those that operators use."""
    more = [(*r, len(r[1]) if r[1] else None, 0.5, 7, "k", "h", 3, "l") for r in rows]
    return spark.createDataFrame(more, COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
