from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text) pairs or longer tuples, with extra columns whose names the operators use, too."""

    def make(rows, schema="doc_id long, text string"):
        frame = spark.createDataFrame(rows, schema)
        for name in ("ids", "n_tokens", "size", "taken", "score", "before", "part", "rid", "words", "slice", "label", "to", "value"):
            frame = frame.selectExpr("*", f"cast(7 as int) as {name}") if name not in frame.columns else frame
        return frame

    return make


@pytest.fixture(scope="session")
def sf():
    return SF if os.path.isdir(SF) else pytest.skip("no test data")
