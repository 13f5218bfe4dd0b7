"""The queries of the training-data operators: thin digests over each operator's own results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_forest, bpe, brown, licenses, line_dedup, packing, quality, simhash, suffix_dedup, toxicity
from .common import table


def op1_brown_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    model = brown.train(docs, learn="not held_out", class_context=True)
    found = brown.score(model.coded, model)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(col).cast("string")) % n


def op3_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann_forest.nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)
    return found.select(F.col("query_id").cast("long").alias("query_id"), "rank", F.col("vec_id").cast("long").alias("vec_id"), "score")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.array_join(F.transform("kept", lambda x: x.cast("string")), ",")
    return found.select("doc_id", "n_lines", F.size("kept").cast("long").alias("n_kept"), kept.alias("kept_lines"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    how = (vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *how).drop("text")
    return bpe.decode(ids, *how).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op9_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=crc_mod("doc_id", 5) != 0)
    s = F.col("toxic_score")
    return toxicity.score(docs, model, spans=True).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        s.alias("score"),
        (s >= 0.5).cast("int").alias("predicted"),
        F.col("toxic_spans").alias("spans"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = F.flatten("phrase_places")
    base = F.array_compact(F.array(*(F.when(F.size(F.col("phrase_places")[i]) > 0, F.lit(x)) for i, x in enumerate(licenses.PHRASES.values()))))
    return found.select(
        "doc_id",
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


SQL: dict[str, str] = {
    "op5_line_dedup": r"""
WITH split AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
l AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
d AS (SELECT w, array_to_string(w, ' ') AS s, len(w) AS n, min({'d': doc_id, 'p': pos}) AS pl FROM l GROUP BY w),
v AS (SELECT pl, n - 1 AS m, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') AS s FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d WHERE n >= 8)),
gone AS (
  SELECT v.pl FROM v JOIN (SELECT s, m, i, min(pl) AS low FROM v GROUP BY s, m, i) g ON v.s = g.s AND v.m = g.m AND v.i = g.i AND v.pl > g.low
  UNION SELECT v.pl FROM v JOIN d ON v.s = d.s AND v.m = d.n AND d.n >= 8 AND v.pl > d.pl
  UNION SELECT d.pl FROM v JOIN d ON v.s = d.s AND v.m = d.n AND d.n >= 8 AND d.pl > v.pl),
k AS (SELECT pl.d AS doc_id, string_agg(pl.p::VARCHAR, ',' ORDER BY pl.p) AS kept_lines, count(*) AS n FROM d WHERE pl NOT IN (SELECT pl FROM gone) GROUP BY 1),
c AS (SELECT doc_id, count(*) AS n FROM l GROUP BY 1)
SELECT documents.doc_id, coalesce(c.n, 0)::BIGINT AS n_lines, coalesce(k.n, 0)::BIGINT AS n_kept, coalesce(k.kept_lines, '') AS kept_lines
FROM documents LEFT JOIN c ON documents.doc_id = c.doc_id LEFT JOIN k ON documents.doc_id = k.doc_id
""",
}
