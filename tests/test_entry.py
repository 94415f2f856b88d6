"""Driver contract: entry() runs; every query has an oracle and matches it (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from pitlake.plans.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["ticker", "date"] and df.count() > 0


def test_every_panel_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def _norm(rows, cols):
    import datetime as dt
    import math
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=None)
        return v
    out = [tuple(n(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in sdf.collect()], sdf.columns) == _norm(res.fetchall(), dcols)
