"""The pipeline's stages over the small documents and over awkward rows."""

import corpus_pipeline
from conftest import SF
from pyspark.sql import functions as F
from test_operators import SCHEMA, TEXTS, exact_groups


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "packing"]
    one = corpus_pipeline.language_id(spark, docs, SF)
    assert one.columns == docs.columns and one.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    two = corpus_pipeline.line_dedup(spark, one, SF)
    assert two.columns == docs.columns and two.where("n_chars <> length(text)").count() == 0
    lines = two.select(F.explode(F.split("text", "\n")).alias("l")).where("size(split(l, ' ')) > 55").groupBy("l").count()
    assert lines.where("count > 1").count() == 0
    three = corpus_pipeline.near_dedup(spark, two, SF)
    texts = {r.doc_id: r.text for r in two.collect()}
    _, root = exact_groups(texts, 5, 4, 5)
    assert {r.doc_id for r in three.collect()} == {d for d in root if root[d] == d} and three.columns == docs.columns
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.collect()} == {d for d in root if root[d] == d}


def test_awkward_rows(spark):
    rows = [(i, t, "en", None, None, "r", 5, 1, 1, "c", "w", 0) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, SCHEMA)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).count()
