from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import edge  # noqa: E402

from headrace.llm import frames  # noqa: E402


@pytest.fixture
def edges(spark):
    return frames.tune(spark).createDataFrame(edge.rows(edge.TEXTS), edge.SCHEMA)


@pytest.fixture
def empty(spark):
    return frames.tune(spark).createDataFrame([], edge.SCHEMA)


@pytest.fixture
def docs(spark):
    def build(*texts: str | None):
        return frames.tune(spark).createDataFrame(edge.rows(list(enumerate(texts))), edge.SCHEMA)

    return build
