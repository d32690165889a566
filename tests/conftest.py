import os
import sys
import tempfile

import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from bagwise import build_session
    s = build_session("local[*]", app="bagwise-tests", shuffle_partitions=8)
    # tests run locally: give the session its own checkpoint folder
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bagwise-test-ckpt-"))
    yield s
    from bagwise.session import release
    release(s)
    s.stop()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def rows_of(pdf, cols=None):
    """Rows as sorted tuples; a null is None and an integer an int, however pandas holds them."""
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return (int(v) if v.is_integer() else round(v, 6)) if isinstance(v, float) else v
    cols = cols or sorted(pdf.columns)
    out = [tuple(map(plain, r)) for r in pdf[cols].itertuples(index=False)]
    return sorted(out, key=repr)
