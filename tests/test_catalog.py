"""Every registered query against its DuckDB oracle (small scale factor), and
plan checks: no Python in any plan, filters and column pruning at the scan."""

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as entry
from sieveflow.plans.catalog import QUERIES
from sieveflow.plans.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL

TABLES = ["events", "documents", "labels", "conversations"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = plan_text(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, f"{name} runs Python in its plan"
    got = df.collect()
    sql = ORACLE_SQL.get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(r) for r in got]) == _rows(cols, want)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(ORACLE_SQL) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert sum(r.total_messages for r in rows) == 200


def test_scan_pruning_and_pushdown(spark):
    q = entry.queries()
    plan = plan_text(q["recent_messages"](spark, SF_SMALL))
    assert "PushedFilters: [Or(IsNull(ts),GreaterThanOrEqual(ts," in plan
    assert "props" not in plan.split("ReadSchema:")[1].splitlines()[0]
    plan = plan_text(q["high_water_mark"](spark, SF_SMALL))
    read = plan.split("ReadSchema:")[1].splitlines()[0]
    assert "value" not in read and "props" not in read


def test_latest_n_is_limited_before_the_shuffle(spark):
    plan = plan_text(entry.queries()["latest_n_per_channel"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_partial_aggregation_for_statistics(spark):
    plan = plan_text(entry.queries()["duplicates_by_reason"](spark, SF_SMALL))
    assert "partial_count" in plan


GLOBAL_TOTALS = {"run_totals", "tracker_statistics", "check_counters", "running_statistics"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - GLOBAL_TOTALS))
def test_no_single_partition_exchange(spark, name):
    """Only global totals may gather into one partition."""
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in plan, name
