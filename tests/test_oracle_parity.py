"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_check import close, duck_conn, rows_of

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_conn(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    sp = E.queries()[name](spark, sf_dir).toPandas()
    dk = con.execute(ORACLES[name]).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    bad = [(a, b) for a, b in zip(r1, r2) if not close(a, b)]
    assert not bad, bad[:3]


def test_every_query_runs(spark, sf_dir):
    for name, fn in E.queries().items():
        if name not in ORACLES:
            rows = fn(spark, sf_dir).toArrow()   # every column is computed
            assert rows.num_rows > 0 and rows.num_columns > 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 23
    assert df.columns == ["feature", "iv", "strength", "n_bins"]
