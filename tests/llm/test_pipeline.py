import corpus_pipeline
from flowstrata.llm.common import table
from flowstrata.llm.golay import near_copies
from flowstrata.llm.qgram import leaked_pairs
from flowstrata.llm.toxfm import toxicity

SF = "/root/testdata/sf0.01"


def test_stages_against_their_operators(spark, tmp_path):
    """Every stage on what its predecessor kept, against the operator's own
    table and plain Python; the last one deals all rows."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / name)
        function(spark, docs, SF).write.parquet(out)
        result = spark.read.parquet(out)
        ids = sorted(r["doc_id"] for r in result.select("doc_id").collect())
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if k < 4:
            assert result.columns == columns
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
            assert ids == sorted(before - bad) and bad
        elif name == "near_duplicates":
            assert ids == sorted({r["component_id"] for r in near_copies(docs).collect()})
        elif name == "decontamination":
            bad = {r["doc_id"] for r in leaked_pairs(docs, table(spark, SF, "benchmark")).collect()}
            assert ids == sorted(before - bad) and bad
        elif name == "mixing":
            assert set(ids) == before and len(ids) >= len(before)
        else:
            assert ids == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
            sizes = [r["count"] for r in result.groupBy("shard").count().collect()]
            assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
        kept[name] = len(ids)
        docs = result
    assert corpus_pipeline.run(spark, SF).count() == kept["sharding"]


def test_odd_documents(spark, odd_docs):
    docs = odd_docs
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, "/root/testdata/sf0.001")
        assert set(docs.columns) <= set(out.columns)
        assert out.count() <= docs.count() * 3
        assert function(spark, odd_docs.where("false"), "/root/testdata/sf0.001").count() == 0
