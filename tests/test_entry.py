"""Driver contract: entry runs, every query has an oracle, and every query matches its oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from logtide.plans import catalog


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "click_count"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


_CON = None


def _duck():
    global _CON
    if _CON is None:
        _CON = duckdb.connect()
        for t in ("events", "lineitem"):
            _CON.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return _CON


def _norm(rows):
    return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else str(v)) for v in r)
                  for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_oracle_pairs(spark, name):
    con = _duck()
    df = E.queries()[name](spark, SF0001)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    srows = [tuple(r[c] for c in dcols) for r in df.collect()]
    assert _norm(srows) == _norm(drows)
