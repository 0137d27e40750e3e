"""Registered queries leave the caller's session as it is."""

from termloom.llm import queries


def test_settings_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    found = queries.REGISTRY["op4_pseudonyms"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == before != str(queries.BATCH_ROWS)
    assert found.sparkSession.conf.get(key) == str(queries.BATCH_ROWS)
    assert found.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
