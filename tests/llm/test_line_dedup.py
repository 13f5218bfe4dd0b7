from sparkfed.llm import line_dedup

from .helpers import empty, frame, odd_documents


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    """Kept line numbers by comparing each line with all earlier ones."""
    order = lambda x: (x is not None, x or 0)
    places = sorted({(order(i), k, tuple(line.encode().split())) for i, t, *_ in rows for k, line in enumerate((t or "").split("\n")) if line.encode().split()})
    first = {}
    for i, k, w in places:
        first.setdefault(w, (i, k))
    stay = {(i, k, w) for w, (i, k) in first.items() if not any(v < (i, k) and len(w) >= 8 and len(o) >= 8 and o != w and one_edit(o, w) for o, v in first.items())}
    return sorted((str(i), [k for k, line in enumerate((t or "").split("\n")) if (order(i), k, tuple(line.encode().split())) in stay]) for i, t, *_ in rows)


def extra():
    w = [f"w{i}" for i in range(12)]
    lines = [w, w[:5] + ["new"] + w[6:], w[:3] + w[4:], [*w, "end"], ["in", *w[:11]], w[:6] + ["x", "y"] + w[6:], w[:7], ["q", *w[1:7]]]
    return [(2000 + i, " ".join(x), "en", "a") for i, x in enumerate(lines)] + [(3000, " ".join(w[:5] + ["old"] + w[6:]) + "\n\n  \nshort", "en", "a")]


def test_against_brute_force(spark):
    rows = odd_documents() + extra()
    got = sorted((str(r["doc_id"]), list(r["kept"])) for r in line_dedup.report(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_collisions_lose_nothing(spark, monkeypatch):
    """With hashes of few values most first links are wrong; the others of the key are tried then."""
    monkeypatch.setattr(line_dedup, "PRIME", 5)
    rows = odd_documents() + extra()
    got = sorted((str(r["doc_id"]), list(r["kept"])) for r in line_dedup.report(frame(spark, rows)).collect())
    assert got == brute(rows)


def test_rewrite(spark):
    rows = odd_documents() + extra()
    df = frame(spark, rows)
    out = line_dedup.rewrite(df)
    assert out.columns == df.columns and out.count() == len(rows)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[2001] == "" and got[3000] == "\n  \nshort" and got[1000] == "" and got[2005] != ""


def test_empty(spark):
    assert line_dedup.report(empty(spark)).count() == 0 and line_dedup.rewrite(empty(spark)).count() == 0


def test_white_space(spark):
    """Words are the same whatever stands between them; control characters that are no white space are words' own."""
    w = [f"w{i}" for i in range(9)]
    texts = [" ".join(w), "\t" + "  ".join(w) + " \r\n\x0b\x0c\n" + "\t ".join(w[:8]), "   ".join(w[:4] + ["x"] + w[5:]) + "  ", " " + "\x0b".join(w[1:]) + "\n  \n\n", "\x1c".join(w) + "\n" + " ".join([*w[:8], "\x1c"]), "é  é\né é\n é"]
    rows = [(4000 + i, t, "en", "a") for i, t in enumerate(texts)]
    for case in (rows, rows + [rows[1], (None, texts[3] + "\nq " + texts[0], None, None)]):
        got = sorted((str(r["doc_id"]), list(r["kept"])) for r in line_dedup.report(frame(spark, case)).collect())
        assert got == brute(case)


def test_variant_keys_are_hashes_of_the_rest(spark):
    from pyspark.sql import functions as F

    w = [f"w{i}" for i in range(10)]
    df = spark.createDataFrame([(i, w, w[:i] + w[i + 1 :]) for i in range(10)], "i int, words array<string>, rest array<string>")
    df = df.select("i", line_dedup.polynomial(F.col("words")).alias("p"), line_dedup.polynomial(F.col("rest")).alias("q"))
    got = df.select(line_dedup.variant_key("p", F.col("i")).alias("key"), F.element_at("q", -1).alias("want"), F.size("p").alias("n")).collect()
    assert all(r["key"] == r["want"] and r["n"] == 11 for r in got) and len({r["key"] for r in got}) == 10


def test_texts_are_split_once(spark):
    """Spark repeats expressions in filters that it infers or moves; a text is split and hashed once, before its lines."""
    from pyspark.sql import functions as F

    df = frame(spark, odd_documents())
    rows = line_dedup.lines(df)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    below = plan[plan.index("Generate") :]
    assert below.count("xxhash64(coalesce(text") == plan.count("xxhash64(coalesce(text") == 1
    chosen = line_dedup.chosen_lines(df, spark.createDataFrame(rows.select("at").collect(), rows.select("at").schema))
    assert chosen._jdf.queryExecution().executedPlan().toString().count("split(") == 1
    want = {(tuple(r["at"]), r["line"]) for r in line_dedup.split_lines(df).where(F.trim("line") != "").collect()}
    got = [(tuple(r["at"]), r["line"]) for r in chosen.collect()]
    assert set(got) == want and len(got) == len(want)


def test_lone_keys_meet_no_join(spark, monkeypatch):
    """Only rows whose key another row has are written for the joins, and all of those."""
    rows = odd_documents() + extra()
    written, real = [], line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df: written.append((df.columns, out := real(df))) or out)
    freed = []
    monkeypatch.setattr(line_dedup, "free", lambda *found: freed.extend(found))
    assert line_dedup.report(frame(spark, rows)).count() == len(rows)
    every, keys = [df for columns, df in written if columns == ["at", "m", "i", "key"]]
    a, b = ([(r["key"], r["m"], tuple(r["at"]), r["i"]) for r in df.collect()] for df in (every, keys))
    n = {}
    for key, m, *_ in a:
        n[key, m] = n.get((key, m), 0) + 1
    assert sorted(b, key=str) == sorted((x for x in a if n[x[:2]] > 1), key=str) and 0 < len(b) < len(a)
    assert every in freed and keys in freed
