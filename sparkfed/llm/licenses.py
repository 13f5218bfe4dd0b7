"""License scans with ordered signature rules, in DataFrame functions alone; rows are scanned in place, nothing is shuffled.

Rules (license_rules.txt) are hand-written regular expressions over the text's words, joined by single spaces. A rule
is tried only where its keyword occurs at a word's start, and rules at all only where one of all keywords does. Every
match of a rule holds its keyword, so that loses nothing. Detections are intervals of characters. They are taken in the
order of the rules, most important first; one that overlaps a detection taken before, lies in it or contains it, is
dropped. So what stays does not overlap.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed phrases whose places are counted, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words in a text whose A-Z are lower case already.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A column of intermediate results.
WORDS = "__sparkfed_words"
#: The strength of a phrase.
PHRASE_SCORE = 0.8


def rules() -> list[tuple[str, float, str, str]]:
    """(label, strength, keyword, pattern), most important first."""
    lines = (Path(__file__).parent / "license_rules.txt").read_text().splitlines()
    split = [[x.strip() for x in line.split("|", 3)] for line in lines if line and line[0] != "#"]
    return [(label, float(s), keyword, rf"(?<= )(?:{pattern})(?= )") for label, s, keyword, pattern in split]


def any_of(words: list[str]) -> str:
    """A regular expression for any of the words, with common beginnings shared: few alternatives are tried at a place."""
    short = [w for w in sorted(set(words)) if not any(w != o and w.startswith(o) for o in words)]
    heads: dict[str, list[str]] = {}
    for w in short:
        heads.setdefault(w[0], []).append(w[1:])
    parts = [h + (any_of(rest) if len(rest) > 1 else rest[0]) for h, rest in heads.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def keywords() -> list[str]:
    return sorted({k for _, _, k, _ in rules()} | set(PHRASES))


def spans(words: Column, rule: Column) -> Column:
    """The rule's matches: array of (rank, start, end, label, strength)."""
    pieces = F.transform(F.split(words, rule["pattern"], -1), F.length)
    sizes = F.transform(F.regexp_extract_all(words, rule["pattern"], F.lit(0)), F.length)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        found = F.struct(rule["rank"].alias("rank"), start.alias("start"), (start + x["size"]).alias("end"), rule["label"].alias("label"), rule["strength"].alias("strength"))
        return F.struct((start + x["size"]).alias("at"), F.array_append(acc["out"], found).alias("out"))

    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(sizes)), sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))
    none = F.array().cast("array<struct<rank:int,start:int,end:int,label:string,strength:double>>")
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]


def detections(words: Column) -> Column:
    """All matches of rules whose keyword occurs, most important rule first, then in order of start."""
    every = [
        F.struct(F.lit(i).alias("rank"), F.lit(label).alias("label"), F.lit(s).alias("strength"), F.lit(" " + k).alias("keyword"), F.lit(p).alias("pattern"))
        for i, (label, s, k, p) in enumerate(rules())
    ]
    tried = F.filter(F.array(*every), lambda r: F.contains(words, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(tried, lambda r: spans(words, r))))


def resolve(found: Column) -> Column:
    """The detections that stay, in order of start: array of (start, end, label, strength)."""

    def step(kept: Column, d: Column) -> Column:
        meets = F.exists(kept, lambda k: (k["start"] < d["end"]) & (d["start"] < k["end"]))
        own = F.struct(d["start"].alias("start"), d["end"].alias("end"), d["label"].alias("label"), d["strength"].alias("strength"))
        return F.when(meets, kept).otherwise(F.array_append(kept, own))

    none = F.array().cast("array<struct<start:int,end:int,label:string,strength:double>>")
    return F.array_sort(F.aggregate(found, none, step))


def places(words: Column, phrase: str) -> Column:
    """Word indexes at which the phrase starts: spaces before it, less the leading one."""
    pieces = F.split(words, f"(?<= )(?={phrase} )", -1)
    per = F.transform(pieces, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))
    starts = F.slice(per, F.lit(1), F.size(per) - 1)
    sums = F.aggregate(starts, F.array().cast("array<int>"), lambda acc, n: F.array_append(acc, F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.lit(-1)) + n))
    return F.when(F.contains(words, F.lit(f" {phrase} ")), sums).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, phrase_places (array per phrase), detections, labels (array) and score.

    Null text counts as empty: no words, no labels, score 0. Offsets of detections are in the joined words. Rows are
    scanned alone, whole however long, so repeated rows and ties change nothing; an empty table gives no rows; result
    columns replace those of the same name."""
    added = ["n_words", "phrase_places", "detections", "labels", "score"]
    docs = docs.select(*(c for c in docs.columns if c not in added))
    raw = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("n_words", F.regexp_count(raw, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long"))
    # A first, loose test for the longest word of any keyword, at a word's start, spares most texts the joining of words.
    loose = "(?i)(?:^|[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F])" + any_of([max(k.split(), key=len) for k in keywords()])
    lowered = F.translate(raw, UPPER, LOWER)
    joined = F.concat(F.lit(" "), F.regexp_replace(lowered, GAP, " "), F.lit(" "))
    joined = F.regexp_replace(joined, "^ +| +$", " ")
    df = df.withColumn(WORDS, F.when(raw.rlike(loose), joined))
    df = df.withColumn(WORDS, F.when(F.col(WORDS).rlike(" " + any_of(keywords())), F.col(WORDS)))
    words = F.col(WORDS)
    nothing = F.array().cast("array<int>")
    df = df.withColumn("phrase_places", F.array(*(F.when(words.isNotNull(), places(words, p)).otherwise(nothing) for p in PHRASES)))
    df = df.withColumn("detections", F.when(words.isNotNull(), resolve(detections(words))))
    df = df.withColumn("detections", F.coalesce("detections", F.array().cast(df.schema["detections"].dataType)))
    base = F.array_compact(F.array(*(F.when(F.size(F.col("phrase_places")[i]) > 0, F.lit(label)) for i, label in enumerate(PHRASES.values()))))
    df = df.withColumn("labels", F.array_sort(F.array_distinct(F.concat(base, F.transform("detections", lambda d: d["label"])))))
    most = F.coalesce(F.array_max(F.transform("detections", lambda d: d["strength"])), F.lit(0.0))
    df = df.withColumn("score", F.greatest(most, F.when(F.size(base) > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))))
    return df.select(*docs.columns, *added)
