"""Every registered query of the relational operators against its SQL in DuckDB; and the entry point."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from concord import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    assert not isinstance(v, (decimal.Decimal, datetime.datetime)), "engines print these differently"
    return str(v), type(v).__name__


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_and_sql_agree(spark, sf, duck, name):
    df = plans.queries()[name](spark, sf)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    got = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert {r.reconciliation_class for r in entry_point.entry(spark).collect()} <= {"both_match", "both_differ", "ours_only", "theirs_only"}


def test_registry_is_whole():
    names = set(entry_point.queries())
    assert names >= set(plans.queries()) and set(entry_point.oracle_sql()) <= names


def test_everything_else_works_without_the_subpackage(monkeypatch):
    import builtins

    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if "llm" in name or name == "corpus_pipeline" or "llm" in (fromlist or ()):
            raise ImportError(name)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", without)
    assert set(entry_point.queries()) == set(plans.queries())


def test_pruned_scan_reads_no_excluded_column(spark, sf):
    plan = plans.queries()["projected_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema")[1]
    assert "c_acctbal" not in schema and "c_name" not in schema and "PushedFilters: [IsNotNull(c_mktsegment)" in plan
