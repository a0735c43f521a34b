"""The registered queries on training text against their SQL twins, on the smallest tables."""

import compare
import corpus_pipeline
import pytest

import __spark_entry__ as entry
from ledgerlane.llm import queries

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram jaccard join", "benchmark decontamination", "pii", "sentencepiece encoding and decoding"]


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query(spark, key):
    assert compare.compare(spark, compare.duck(SF), SF, key, queries.QUERIES[key], queries.SQL[key]) is None
