"""Every catalog query against its DuckDB twin on sf0.001 (the driver runs
the same comparison on sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from paths import SF_SMALL  # noqa: E402
from check_oracle import TABLES, digest_rows  # noqa: E402

import __spark_entry__ as E  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


#: Queries of subpackage llm that SQL cannot express have tests of their own.
NAMES = sorted(E.oracle_sql())


def test_every_query_has_an_oracle():
    from pairloom.plans.catalog import QUERIES

    # SQL has no sub-word tokenizer; tests/test_encoders.py compares with direct calls
    assert set(QUERIES) - {"encoder_ids"} <= set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    hs, _ = digest_rows(df.columns, srows)
    hd, _ = digest_rows(dcols, drows)
    assert hs == hd


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2
    assert set(df.columns) == {"is_next", "n_examples", "real_tokens", "scored_tokens"}
