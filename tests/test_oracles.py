"""Every exact query against its DuckDB oracle on the smallest test tables (layer 2).

The same comparison runs at sf0.01 with ``python scripts/oracle_check.py``.
"""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF_DIR = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF_DIR)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import table_hash
    df = E.queries()[name](spark, SF_DIR)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert table_hash(df.columns, srows)[0] == table_hash(dcols, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == ["location", "year", "bloom_doy", "lat", "long", "bloom_date", "alt"]


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert len(qs) >= 61
