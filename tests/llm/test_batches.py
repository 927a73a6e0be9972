"""Rows go to the workers of the pipeline a few MB at a time."""

import pyarrow as pa

import corpus_pipeline
from tallybrook import session


def test_packing_gets_texts_a_few_megabytes_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    spark.conf.unset(session.ARROW_BYTES)
    try:
        docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('wort ', 1000) AS text")
        corpus_pipeline.pack_tokens(spark, docs, "")
        assert max(r["size"] for r in docs.mapInArrow(sizes, "size long").collect()) < 5 << 20
        spark.conf.set(session.ARROW_BYTES, "1m")
        corpus_pipeline.pack_tokens(spark, docs, "")
        assert spark.conf.get(session.ARROW_BYTES) == "1m"
    finally:
        spark.conf.unset(session.ARROW_BYTES)
