"""Every registered query of the library against its DuckDB SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from isobar import plans

SF = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def text(v):
    return v.isoformat().replace("+00:00", "") if hasattr(v, "isoformat") else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, tables, name):
    ours, theirs = QUERIES[name](spark, SF), tables.sql(SQL[name])
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    place = [theirs.columns.index(c) for c in cols]
    assert sorted([text(r[c]) for c in cols] for r in ours.collect()) == sorted([text(r[i]) for i in place] for r in theirs.fetchall())


def test_consensus_tasks_grow_with_rows(spark, monkeypatch):
    """A task of the consensus takes so many rows, whatever the table has; the rows stay the same."""
    from isobar.plans import consensus

    whole = consensus.family_balanced_consensus(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(consensus, "ROWS_A_TASK", 100)
    dealt = consensus.family_balanced_consensus(spark, "/root/testdata/sf0.001")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(dealt) == rows(whole) and dealt.rdd.getNumPartitions() >= 60
