import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id bigint, text string"


@pytest.fixture
def docs_of(spark):
    """A frame of documents, with further columns whose names clash with those operators use."""

    def make(rows):
        frame = spark.createDataFrame([(i, t, "x", -1, [0]) for i, t in rows], DOCUMENTS + ", score string, length int, rep array<int>")
        return frame

    return make


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
