"""The pipeline's stages bound what one batch holds of whole texts."""

import pyarrow as pa
import pytest

import corpus_pipeline
from lendlens.llm.memory import BATCHES, small_batches


@pytest.fixture
def defaults(spark):
    before = {k: spark.conf.get(k) for k in BATCHES}
    yield before
    for k, v in before.items():
        spark.conf.set(k, v)


def test_batches_of_long_texts(spark, defaults):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["bytes", "rows"])

    docs = spark.range(300, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 10000) AS text")
    corpus_pipeline.line_stage(spark, docs.limit(1), "")
    got = docs.mapInArrow(sizes, "bytes bigint, rows bigint").collect()
    assert sum(r["rows"] for r in got) == 300 and len(got) > 4
    assert max(r["bytes"] for r in got) <= (4 << 20) + (1 << 18)


def test_given_configuration_stays(spark, defaults, monkeypatch):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    given = spark.sparkContext.getConf().set(key, "4096")
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: given)
    spark.conf.set(key, "4096")
    small_batches(spark)
    assert spark.conf.get(key) == "4096"
