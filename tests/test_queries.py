"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys

import pytest
from compare import connect, differences

from conftest import ROOT
from tallygrid.checks import catalog


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(name, spark, small, con):
    assert differences(catalog.QUERIES[name](spark, small), con, catalog.SQL[name]) == {}


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


@pytest.mark.parametrize("missing", ["zstandard", "public_tokenizers", "tallygrid.llm"])
def test_entry_outlives_what_only_llm_needs(missing):
    script = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'op1_toxicity' in e.queries())"
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert out.stdout.split() == [str(len(catalog.QUERIES)), "False"] and "left out" in out.stderr


def test_entry_has_the_detail_columns(spark):
    import __spark_entry__ as entry

    frame = entry.entry(spark)
    assert frame.columns[0] == "run_id" and "measure_value" in frame.columns and not frame.isEmpty()
