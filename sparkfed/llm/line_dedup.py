"""Lines that repeat earlier ones, exactly or but for one word, in DataFrame functions alone.

A line is its sequence of words; lines without a word are left alone. Of equal lines the earliest stays (smallest
doc_id, then line number). A line of min_words words or more also goes if an earlier such line turns into it by one edit:
a word put in, left out or replaced. This is judged on the input, not on what is left. min_words is part of what a
near line is, whatever the table's size; with 1, every line takes part.

Deletion neighbourhoods: each distinct line emits the hash of every variant with one word left out. Lines that agree in
a variant and in the place left out differ by a replacement; a line that equals another's variant differs by a word
left out. Each key's earliest line is a minimum, so links are never emitted as pairs within a group: a line needs the
earliest one alone. Every link is then verified on the words themselves; where two different variants had one hash, all
earlier lines of that key are tried.

Before that, lines that cannot have a partner are set aside, without loss: one edit leaves either the first or the last
half of the shorter line as it was, so a line whose halves occur in no other line emits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, materialise

MIN_WORDS = 8
#: White space that separates words within a line, but for the space itself.
OTHER_SPACE = "\t\x0b\x0c\r"
#: A polynomial hash has two bases modulo a prime; products of two residues fit a long.
PRIME, BASES = 2**31 - 1, (1_000_003, 998_244_353)


def plain_text() -> Column:
    """The text, empty where it is null, in which only spaces separate the words of a line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    other = [text.contains(c) for c in OTHER_SPACE]
    return F.when(other[0] | other[1] | other[2] | other[3], F.translate(text, OTHER_SPACE, " " * len(OTHER_SPACE))).otherwise(text)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def split_lines(docs: DataFrame) -> DataFrame:
    """(at, line): a row for each line, at (doc_id, line number, hash of the text); only spaces separate words."""
    rows = docs.select("doc_id", text_hash().alias("th"), F.split(plain_text(), "\n", -1).alias("lines"))  # one hash a text
    # A split is never empty; _outer says so to Spark, which would else split twice, to leave out empty ones.
    rows = rows.select("doc_id", "th", F.posexplode_outer("lines").alias("pos", "line"))
    return rows.select(F.struct("doc_id", "pos", "th").alias("at"), "line")


def chosen_lines(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(at, line) of split_lines() for the places in chosen (at), once each. Whole texts meet their places, not lines."""
    places = chosen.groupBy(F.struct("at.doc_id", "at.th").alias("doc")).agg(F.collect_set("at.pos").alias("places"))
    texts = docs.select(F.struct("doc_id", text_hash().alias("th")).alias("doc"), "text").join(places.hint("merge"), "doc")
    doc = F.col("doc")
    found = lambda x: F.transform("places", lambda i: F.struct(F.struct(doc["doc_id"], i.alias("pos"), doc["th"]).alias("at"), F.get(x, i).alias("line")))
    once = F.flatten(F.transform(F.array(F.split(plain_text(), "\n", -1)), found))  # the text is split once, not for each place
    return texts.select(F.explode_outer(once).alias("x")).select("x.at", "x.line").dropDuplicates(["at"])


def lines(docs: DataFrame) -> DataFrame:
    """A row for each line with a word: at, s (its words, a space between them), n, h (128 bits)."""
    line = F.col("line")
    s = F.trim(F.when(line.contains("  "), F.regexp_replace(line, " +", " ")).otherwise(line))
    rows = split_lines(docs).where(F.trim("line") != "").select("at", s.alias("s"))
    h = F.struct(F.xxhash64("s").alias("a"), F.xxhash64(F.lit(1), "s").alias("b"))
    return rows.select("at", "s", (F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) + 1).alias("n"), h.alias("h"))


def split_words(line: Column) -> Column:
    return F.array_remove(F.split(line, " ", -1), "")


def half_keys(s: Column, n: Column) -> Column:
    """Keys of which two lines within one edit share one: halves of a length, the line's own or one less. s: the line's n
    words, a space between them."""

    def two(m: Column) -> list[Column]:
        half = (m / 2).cast("int")
        some = lambda k: F.call_function("substring_index", s, F.lit(" "), k)
        return [F.xxhash64(F.lit(0), m, some(half)), F.xxhash64(F.lit(1), m, some(half - m))]

    return F.array(*two(n), *two(n - 1))


def polynomial(words: Column) -> Column:
    """Hashes of the first 0, 1, … n words by both bases, in one long each: the first base's residue from bit 31 on.

    Word j is weighed with the base to the j: without an earlier word, a division by the base moves it one place down."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    start = F.struct(F.array().cast("array<long>").alias("before"), zero.alias("p0"), zero.alias("p1"), one.alias("w0"), one.alias("w1"))
    packed = lambda acc: acc["p0"] * (2**31) + acc["p1"]

    def add(acc: Column, h: Column) -> Column:
        own = F.pmod(h, F.lit(PRIME)) + 1, F.pmod(F.shiftrightunsigned(h, 32), F.lit(PRIME)) + 1  # of different bits
        p = [((acc[f"p{k}"] + own[k] * acc[f"w{k}"] % PRIME) % PRIME).alias(f"p{k}") for k in range(2)]
        w = [(acc[f"w{k}"] * base % PRIME).alias(f"w{k}") for k, base in enumerate(BASES)]
        return F.struct(F.array_append(acc["before"], packed(acc)).alias("before"), *p, *w)

    return F.aggregate(F.transform(words, lambda w: F.xxhash64(w)), start, add, lambda acc: F.array_append(acc["before"], packed(acc)))


def variant_key(p: str, i: Column) -> Column:
    """The hash of the line without word i, of 62 bits."""
    parts = []
    halves = lambda x: (F.shiftright(x, 31), x.bitwiseAND(2**31 - 1))
    for before, upto, total, base in zip(halves(F.get(p, i)), halves(F.get(p, i + 1)), halves(F.element_at(p, -1)), BASES):
        parts.append((before + F.pmod(total - upto, F.lit(PRIME)) * pow(base, -1, PRIME) % PRIME) % PRIME)
    return parts[0] * (2**31) + parts[1]


def near(found: DataFrame, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(at, of): distinct lines that an earlier one turns into by one edit, and the earliest such; both are first places.

    found: distinct lines with first, n, h and keys."""
    wide = found.where(F.col("n") >= min_words)
    shared = wide.select(F.explode(F.array_distinct("keys")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    lively = materialise(wide.select(F.col("first").alias("at"), F.explode("keys").alias("key")).join(shared, "key", "left_semi").select("at").distinct())
    text = chosen_lines(docs, lively)
    text = materialise(text.select("at", split_words(F.col("line")).alias("words")).withColumn("n", F.size("words")))
    free(lively)
    # One row for each word left out, and one, with i = -1, for the line itself; the hashes are computed once.
    i, n = F.col("i"), F.col("n")
    rows = text.select("at", "n", polynomial(F.col("words")).alias("p")).select("at", "n", "p", F.explode(F.sequence(F.lit(-1), n - 1)).alias("i"))
    own = F.element_at("p", -1)
    every = materialise(rows.select("at", F.when(i < 0, n).otherwise(n - 1).alias("m"), "i", F.when(i < 0, own).otherwise(variant_key("p", i)).alias("key")))
    # All links are between rows of one key: the others, most of them, are left out before the joins.
    met = every.groupBy("key", "m").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key", "m")
    keys = materialise(every.join(met.hint("merge"), ["key", "m"], "left_semi").select(*every.columns))
    free(every)
    whole, variants = keys.where("i < 0").select("at", "m", "key"), keys.where("i >= 0")
    same = variants.groupBy("key", "m", "i").agg(F.min("at").alias("low"), F.max("at").alias("high")).where("low <> high").drop("high")
    replaced = variants.join(same, ["key", "m", "i"]).where("at > low").select("at", F.col("low").alias("of"), "key", "m", "i")
    beside = variants.groupBy("key", "m").agg(F.min("at").alias("low"))
    put = beside.join(whole, ["key", "m"]).where("at > low").select("at", F.col("low").alias("of"), "key", "m", F.lit(-1).alias("i"))
    left_out = variants.join(whole.select("m", "key", F.col("at").alias("of")), ["key", "m"]).where("at > of").select("at", "of", "key", "m", F.lit(-2).alias("i"))
    checked = materialise(verified(replaced.union(put).union(left_out), text))
    links = checked.where("good").select("at", "of")
    wrong = checked.where("not good and i > -2")
    if not wrong.isEmpty():  # different variants with one hash: all earlier lines of that key
        earlier = variants.select(F.col("at").alias("of"), "key", "m", F.col("i").alias("place"))
        more = wrong.drop("of", "good").join(earlier, ["key", "m"]).where("at > of and (i = -1 or place = i)").select("at", "of", "key", "m", "i").distinct()
        links = links.union(materialise(verified(more, text)).where("good").select("at", "of"))
    links = materialise(links.groupBy("at").agg(F.min("of").alias("of")))
    free(text, keys, checked)
    return links


def verified(links: DataFrame, text: DataFrame) -> DataFrame:
    """links with good: whether all but one word of the longer line are in a common start and a common end."""
    x, y = text.select(F.col("at"), F.col("words").alias("x")), text.select(F.col("at").alias("of"), F.col("words").alias("y"))
    pairs = links.join(x, "at").join(y, "of")
    apart = F.array_position(F.zip_with("x", "y", lambda a, b: a.eqNullSafe(b)), False)  # first difference, from 1; 0: none
    nx, ny, at = F.size("x"), F.size("y"), F.col("_apart")
    rest_x, rest_y = (F.slice(w, at + F.when(n >= m, 1).otherwise(0), n) for w, n, m in (("x", nx, ny), ("y", ny, nx)))
    good = (F.abs(nx - ny) <= 1) & (at > 0) & (rest_x == rest_y)
    return pairs.withColumn("_apart", apart.cast("int")).select(*links.columns, good.alias("good"))


def decisions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Distinct lines: first (the earliest place), n, n_places, near (whether an earlier line is one edit away), of."""
    rows = lines(docs).withColumn("keys", F.when(F.col("n") >= min_words, half_keys(F.col("s"), F.col("n"))))
    found = rows.groupBy("h").agg(F.min("at").alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n_places"))
    found = materialise(found)
    gone = near(found, docs, min_words).select(F.col("at").alias("first"), "of")
    return found.select("first", "n", "n_places").join(gone, "first", "left").withColumn("near", F.col("of").isNotNull())


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, kept): the numbers of the lines with a word that stay, ascending; no row for a text without any."""
    stay = decisions(docs, min_words).where(~F.col("near"))
    return stay.groupBy("first.doc_id", "first.th").agg(F.array_sort(F.collect_list("first.pos")).alias("kept"))


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines (with a word) and kept (numbers of those that stay, from 0) for each row of docs.

    Null text counts as empty. Rows that share id and text share places, and keep the same lines; null ids come first
    in the order. An empty table gives no rows, further columns are ignored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = F.size(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_th"), counted.cast("long").alias("n_lines"))
    kept = kept_lines(docs, min_words)
    on = rows["_id"].eqNullSafe(kept["doc_id"]) & (rows["_th"] == kept["th"])
    return rows.join(kept, on, "left").select(F.col("_id").alias("doc_id"), "n_lines", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))


def rewrite(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with only the lines that stay in text, and those without a word between them; null text becomes empty.

    A row whose lines all go stays, with what is left of its text. Columns stay as they are."""
    kept = kept_lines(docs, min_words).select(F.col("doc_id").alias("__sparkfed_id"), F.col("th").alias("__sparkfed_th"), F.col("kept").alias("__sparkfed_kept"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("__sparkfed_text", text)
    on = rows["doc_id"].eqNullSafe(kept["__sparkfed_id"]) & (F.xxhash64("__sparkfed_text") == kept["__sparkfed_th"])
    rows = rows.join(kept, on, "left")
    split = F.split("__sparkfed_text", "\n", -1)
    blank = F.filter(F.sequence(F.lit(0), F.size(split) - 1), lambda i: ~F.get(F.col("__sparkfed_lines"), i).rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("__sparkfed_lines", split).withColumn("__sparkfed_stay", F.array_sort(F.concat(F.coalesce("__sparkfed_kept", F.array().cast("array<int>")), blank)))
    new = F.array_join(F.transform("__sparkfed_stay", lambda i: F.get(F.col("__sparkfed_lines"), i)), "\n")
    kind = docs.schema["text"].dataType
    return rows.withColumn("text", new.cast(kind)).select(*docs.columns)
