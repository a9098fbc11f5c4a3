"""The pipeline: stages keep their contract, and its rows are whole."""

from collections import defaultdict


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = [docs.count()]
    cols = docs.columns
    for name, stage in p.STAGES:
        docs = p.stored(stage(spark, docs, sf_dir), name)
        left.append(docs.count())
        if name != p.STAGES[-1][0]:
            assert docs.columns == cols
    assert left[1] < left[0] and left[2] == left[1] and left[3] < left[2] and left[4] == left[3]
    assert docs.select("doc_id").distinct().count() == left[4]
    at = defaultdict(int)
    for r in docs.collect():
        at[r.doc_id] += r.length
        total = r.doc_tokens if r.start + r.length == r.doc_tokens else None
        assert total is None or total >= r.length
    assert len(at) == left[4]
