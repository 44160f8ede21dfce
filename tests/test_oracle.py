"""Differential check: every registered query against its DuckDB SQL on the
sf0.001 tables (the driver runs the same comparison at sf0.01)."""

import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from samples import SF_SMALL

TABLES = ["conversations", "customer", "documents", "lineitem", "orders", "pages"]
QUERIES = E.queries()
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.sha1("|".join(_norm(r[i]) for i in order).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_is_registered_with_sql():
    assert set(SQL) <= set(QUERIES)
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}  # the others have tests of their own
    assert own <= set(SQL)


def test_the_clamp_letters_and_quotes_are_reached(con):
    assert con.execute(f"SELECT count(*) FROM ({SQL['general_rank_clamped']}) WHERE rank = 1").fetchone()[0] > 0
    assert con.execute(f"SELECT count(*) FROM ({SQL['user_lookup_letters']}) WHERE user_id LIKE 'User%'").fetchone()[0] > 0
    assert con.execute(f"SELECT count(*) FROM ({SQL['nodes_json_quoted']})").fetchone()[0] > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)
