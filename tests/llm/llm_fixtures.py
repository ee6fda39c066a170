"""Helpers of the tests in this folder."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.extend(p for p in (ROOT, os.path.join(ROOT, "tests")) if p not in sys.path)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    def make(rows, columns="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, columns).repartition(parts)

    return make


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
