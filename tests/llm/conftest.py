from __future__ import annotations

import pytest

from punctual.runtime import visible_to_workers


@pytest.fixture(autouse=True)
def workers(spark):
    visible_to_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """doc_id and text of the smallest test table, on the driver."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
