"""Each stage takes effect on what the one before kept, and the end result is what its parts say."""

import corpus_pipeline
from sparkfed.llm import queries
from sparkfed.llm.common import materialise, table

from .helpers import empty, frame, odd_documents

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {k: {r["doc_id"]: r["text"] for r in v.collect()} for k, v in kept.items() if k != "packing"}
    assert set(ids["toxicity"]) < set(before) and all(ids["toxicity"][i] == before[i] for i in ids["toxicity"])
    assert set(ids["line_dedup"]) == set(ids["toxicity"])
    lines = [line for i in sorted(ids["line_dedup"]) for line in ids["line_dedup"][i].split("\n") if line.split()]
    assert len(lines) == len(set(lines))
    assert set(ids["simhash_near_dedup"]) < set(ids["line_dedup"]) and set(ids["suffix_dedup"]) == set(ids["simhash_near_dedup"])
    seen = set()
    for i in sorted(ids["suffix_dedup"]):
        t = ids["suffix_dedup"][i]
        assert len(t) <= len(ids["simhash_near_dedup"][i])
        seen.add(i)
    packed = kept["packing"].toPandas()
    assert set(packed["doc_id"]) == seen and packed.groupby("sequence_id")["length"].sum().max() <= 1024
    again = corpus_pipeline.run(spark, SF).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again[key].to_numpy().tolist())) == sorted(map(tuple, packed[key].to_numpy().tolist()))


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {n for n in queries.queries()} <= names
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing columns go through all stages; so does an empty table."""
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, None, None)], "doc_id long, quality long, toxic long")
    for name, docs in (("odd", frame(spark, odd_documents())), ("none", empty(spark))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    ids = {r["doc_id"] for r in got}
    # copies go, and of texts that are empty by then all but the first
    assert {None, 0} <= ids and not {1000, 1001, 1002, 1004} & ids
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
