"""Every query of the engine against its SQL twin on the smallest tables, and those without one for rows and invariants."""

import math

import duckdb
import pytest

from kindred import plans
from kindred.session import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else float(v) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_rows_as_sql(spark, sql, name):
    df = plans.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = sql.execute(plans.oracle_sql()[name])
    names = [d[0] for d in found.description]
    theirs = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())
    assert sorted(names) == columns and ours == theirs


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_rows_come_out(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0


def test_greedy_pairs_are_one_to_one(spark):
    rows = [r for r in plans.queries()["q22_greedy_one_to_one"](spark, SF).collect() if r.linked]
    pairs = {(r.pe_a, r.pe_b[:4]) for r in rows}
    assert len(pairs) == len(rows)
