"""Every deterministic registered query equals its DuckDB oracle (sf0.001)."""
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, duck, rows_of

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "token", "count", "rank"]
    assert df.count() > 0


def test_import_needs_no_session():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries(); e.oracle_sql()"], cwd=root, capture_output=True)
    assert done.returncode == 0, done.stderr[-500:]
