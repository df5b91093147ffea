"""The registered corpus queries against their SQL, and the entry with and without the subpackage."""

import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from cohortgraph.llm import registry
from compare import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", registry.ORACLES)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, note


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_entry_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == 'corpus_pipeline' or name.startswith('cohortgraph.llm'):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 200 and not any(q.startswith('op') or q == 'pipeline' for q in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0], timeout=120)
