from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from riskfeat.llm import bytepair, queries
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs, out
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        docs = out
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    before, after = seen["quality classifier"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(texts(before)) - set(texts(after))
    assert sum(labels.get(i) == 0 for i in gone) > 0.9 * sum(v == 0 for v in labels.values())
    assert sum(labels.get(i) == 1 for i in gone) < 0.01 * sum(v == 1 for v in labels.values())

    before, after = map(texts, seen["simhash near-dedup"])
    assert set(after.values()) == set(after.values()) and len(set(after.values())) == len(after)
    assert set(after) <= set(before) and len(after) >= len(set(before.values())) * 0.9

    before, after = map(texts, seen["personal data"])
    assert set(before) == set(after)
    assert any("<EMAIL>" in t for t in after.values()) and not any("@mail" in t for t in after.values())
    assert sum(before[i] != after[i] for i in before) < 0.2 * len(before)

    before, after = seen["mixing to target weights"]
    copies = Counter(r["doc_id"] for r in after.collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(texts(before))

    before, after = seen["byte-level bpe"]
    ranks = bytepair.codec(public_tokenizers.path(bytepair.VOCABULARY)).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    source = texts(before)
    for r in after.collect():
        assert list(memoryview(bytes(r["ids"])).cast("I")) == library.encode_ordinary(source[r["doc_id"]] or "")


def test_odd_documents_pass_all_stages(spark, odd, nothing, tmp_path):
    spark.createDataFrame([(4, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for start in (odd, nothing, frame(spark, [(1, None, None, None)])):
        docs = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if k + 1 < len(corpus_pipeline.STAGES):
                assert docs.columns == start.columns
        docs.collect()


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and set(queries.QUERIES) <= names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
