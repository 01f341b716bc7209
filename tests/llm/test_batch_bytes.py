"""The pipeline's stages send texts to Python in batches of bounded bytes."""
import pyarrow as pa

import corpus_pipeline


def _largest(docs) -> int:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    return docs.select("text").mapInArrow(run, "n long").agg({"n": "max"}).first()[0]


def test_batches_are_bounded(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 700) AS text", "'en' AS lang", "'s' AS source")
    key = corpus_pipeline.ARROW_BYTES
    spark.conf.unset(key)
    try:
        assert _largest(docs) > 2 * corpus_pipeline.BATCH_BYTES
        corpus_pipeline.STAGES[0][1](spark, docs, "")
        assert _largest(docs) < 1.1 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(key, str(1 << 20))
        corpus_pipeline.STAGES[0][1](spark, docs, "")
        assert spark.conf.get(key) == str(1 << 20)   # the owner's bound stays
    finally:
        spark.conf.unset(key)
