"""Every registered query against its SQL twin on the smallest test tables."""

import os
import shutil
import subprocess
import sys

import compare
import pytest

import __spark_entry__ as entry
from ledgerlane import workload

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# The queries on training text are compared in tests/llm.
QUERIES, SQL = workload.QUERIES, workload.SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    assert compare.compare(spark, con, SF_DIR, key, QUERIES[key], SQL.get(key)) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


LEFT_OUT = """
import sys
sys.modules.update(dict.fromkeys({blocked!r}))  # None stands for a module that cannot be imported
import __spark_entry__ as entry
from ledgerlane import workload
assert entry.queries().keys() == workload.QUERIES.keys() and entry.oracle_sql().keys() == workload.SQL.keys()
"""


@pytest.mark.parametrize("folders,blocked", [(["ledgerlane/llm", "corpus_pipeline.py"], []), (["ledgerlane/llm"], []), ([], ["zstandard", "ahocorasick"])])
def test_the_rest_registers_alone(tmp_path, folders, blocked):
    """Without the folder of the training-text operators, or without a library they need, everything else is there."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    gone = {os.path.join(root, f) for f in folders}
    shutil.copytree(root, tmp_path / "copy", ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__") or os.path.join(at, n) in gone])
    subprocess.run([sys.executable, "-c", LEFT_OUT.format(blocked=blocked)], cwd=tmp_path / "copy", check=True, env={**os.environ, "PYTHONPATH": str(tmp_path / "copy")})
