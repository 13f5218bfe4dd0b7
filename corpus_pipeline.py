"""The corpus pipeline: stages that filter, clean and pack whole documents, each over all that its predecessor kept.

toxicity            documents with a toxic score of 0.5 or more go
line_dedup          lines that repeat earlier ones, exactly or but for one word, go; documents stay
simhash_near_dedup  one document, that of the smallest id, stays of each near-duplicate group (texts whose sets of
                    five-word shingles have a similarity of 0.8 or more, verified exactly; candidates are linked by
                    SimHash within 4 bits, or share least shingles, which finds what SimHash's radius leaves out)
suffix_dedup        passages of 100 bytes or more that occur earlier go; documents stay
packing             what is left is packed into sequences of 1024 tokens

Each stage takes any table with the columns of documents. Null text counts as empty from line_dedup on; rows with a null
id are never learned from, stay in the near-duplicate stage, and come first in the orders of the others. Repeated rows
stay repeated up to the suffix stage, which cuts what they share from all but one. Ties go to the smaller id. Very long texts are
read whole. An empty table stays empty; further columns are passed on up to packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfed.llm import line_dedup, packing, queries, simhash, suffix_dedup, toxicity
from sparkfed.llm.common import settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic score under 0.5; null and empty texts have the score of no words, and are kept or not by it."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=queries.crc_mod("doc_id", 5) != 0)
    return toxicity.score(docs, model, spans=False).where(F.col("toxic_score") < 0.5).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the lines that stay; one without a line left stays with an empty text."""
    return line_dedup.rewrite(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All but those whose group has a smaller id. Texts of fewer than five words are one shingle; empty ones are equal."""
    return simhash.keep_first(docs, shingle=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the bytes that stay; a text of which all goes stays, empty."""
    return suffix_dedup.rewrite(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document; an empty text is its closing id."""
    return packing.pack(docs, queries.vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash_near_dedup", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]
#: The stages of toxicity, suffixes and packing are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each one's result written and read again, and its own files then removed."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(lambda f=stage, d=docs: f(spark, d, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
