"""Stages of the pipeline bound the batches of the session that runs them: each test gets back what was set."""

import pytest

KEYS = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture(autouse=True)
def settings_of_its_own(spark):
    before = {key: spark.conf.get(key) for key in KEYS}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)
