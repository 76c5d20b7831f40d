"""Queries held against their SQL on tables that are deeper or larger than the given ones."""

import re

import duckdb
import pytest

from tidemark.operators import facts, intervals, recipes, tree
from tidemark.plans import detail_queries, item_queries, scale_queries  # noqa: F401
from tidemark.plans import queries as plan_queries
from tidemark.sources.work import Scratch


def held(spark, folder, name):
    """A query's rows and those of its SQL over the tables in a folder."""
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = con.execute(plan_queries.ORACLE_SQL[name])
    names = [d[0] for d in got.description]
    plain = lambda v: v.isoformat()[:19] if hasattr(v, "isoformat") else v
    want = sorted(repr(tuple(plain(v) for v in r)) for r in got.fetchall())
    df = plan_queries.QUERIES[name](spark, str(folder))
    assert sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect()) == want
    return want


@pytest.fixture
def deep_events(tmp_path):
    """The left edge of the heap with some of its brothers, 14 levels: what 6 million events come to, and one more."""
    edge = [0]
    for _ in range(13):
        edge.append(4 * edge[-1] + 1)
    ids = sorted({i + k for i in edge for k in (0, 1, 2)})
    rows = ", ".join(f"({i}, TIMESTAMP '2024-01-{1 + i % 28:02d} 10:00:00', {i % 7}, 'view', {i % 40}.5, NULL)" for i in ids)
    duckdb.sql(f"COPY (SELECT v.event_id::BIGINT AS event_id, ts, user_id::BIGINT AS user_id, event_type, value::DOUBLE AS value, props::VARCHAR AS props FROM (VALUES {rows}) v(event_id, ts, user_id, event_type, value, props)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    return tmp_path


@pytest.mark.parametrize("name", ["dense_levels", "sort_path", "rollup_path", "tree_rebuild", "work_items", "typed_levels"])
def test_hierarchies_deeper_than_their_level_columns(spark, deep_events, name):
    held(spark, deep_events, name)


def test_cycles_are_found_at_any_depth(spark):
    rows = [(i, (i + 1) % 5 if i < 5 else i - 5, "x") for i in range(20)]
    loop = spark.createDataFrame([*rows, (30, 30, "y")], "id long, parent long, code string")
    for part in (loop, loop.where("id < 30"), loop.where("id = 30")):
        with pytest.raises(ValueError, match="cycle"):
            tree.sort_paths(part, "id", "parent", "code", None)


def test_allocated_days_travel_as_blocks(spark, tmp_path, monkeypatch):
    """Days are listed behind the last exchange of single rows: no exchange carries one row a day."""
    duckdb.sql(f"COPY (SELECT i // 3 AS l_orderkey, i % 40 AS l_partkey, i % 7 AS l_suppkey, (i % 4)::INTEGER AS l_linenumber, (i % 400)::DOUBLE AS l_quantity, i * 1300.5 AS l_extendedprice, TIMESTAMP '1969-11-28 08:00:00' + INTERVAL (i) DAY AS l_shipdate FROM range(500) t(i)) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    monkeypatch.setattr(facts, "partitions", lambda df: 3)
    for name in ("capacity_grid", "day_allocation", "conflict_days"):
        assert held(spark, tmp_path, name)
        plan = plan_queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        exchanges = [line.partition("Exchange hashpartitioning(")[2] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert exchanges and not [x for x in exchanges if "alloc_date" in x or "period" in x or "_groupingexpression" in x]


def test_range_totals_write_no_pairs(spark, tmp_path):
    """All 300 ranges hold most of the 2,000 points; as pairs they were 600,000 rows."""
    points = spark.range(-500, 1500).selectExpr("id AS p").unionByName(spark.createDataFrame([(None,), (7,)], "p long"))
    ranges = spark.range(300).selectExpr("id AS k", "id % 7 - 600 AS lo", "IF(id % 50 = 3, -700, 1400 + id) AS hi")
    kept = Scratch(spark)
    totals = {"n": ("k", "count"), "least": ("k", "min"), "most": ("k", "max"), "all": ("k", "sum")}
    got = intervals.range_totals(points, ranges, "p", "lo", "hi", totals, scratch=kept)
    plain = {}
    held_by = [(k, k % 7 - 600, -700 if k % 50 == 3 else 1400 + k) for k in range(300)]
    for p in range(-500, 1500):
        ks = [k for k, lo, hi in held_by if lo <= p <= hi]
        plain[p] = (len(ks), min(ks, default=None), max(ks, default=None), sum(ks) if ks else None)
    rows = got.collect()
    assert len(rows) == 2002 and all((r["n"], r["least"], r["most"], r["all"]) == plain.get(r["p"], (0, None, None, None)) for r in rows)
    assert sum(spark.read.parquet(f"{kept.root}/{i}").count() for i in range(1, kept.n + 1)) < 10_000


def _odd_lines(folder):
    duckdb.sql(f"COPY (SELECT i // 5 AS l_orderkey, i * i % 23 AS l_partkey, i % 7 AS l_suppkey, (1 + i % 4)::INTEGER AS l_linenumber, (i % 3)::DOUBLE AS l_quantity, substr('ARN', 1 + (i % 3)::INTEGER, 1) AS l_returnflag, TIMESTAMP '2024-01-28 08:00:00' + INTERVAL (i) DAY AS l_shipdate FROM range(400) t(i)) TO '{folder}/lineitem.parquet' (FORMAT parquet)")
    duckdb.sql(f"COPY (SELECT i AS p_partkey FROM range(30) t(i)) TO '{folder}/part.parquet' (FORMAT parquet)")


def _exchanges(spark, folder, name):
    plan = plan_queries.QUERIES[name](spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_worklog_rows_travel_once(spark, tmp_path, monkeypatch):
    _odd_lines(tmp_path)
    monkeypatch.setattr(recipes, "partitions", lambda df: 3)
    assert held(spark, tmp_path, "worklog_fact")
    assert not [x for x in _exchanges(spark, tmp_path, "worklog_fact") if "l_orderkey" in x.partition("Exchange hashpartitioning(")[2]]


@pytest.mark.parametrize("name", ["link_bridge", "link_statuses", "link_table"])
def test_links_pair_lines_once(spark, tmp_path, monkeypatch, name):
    """Repeated line numbers included; lines are read and joined once, whatever reads the pairs after that."""
    _odd_lines(tmp_path)
    monkeypatch.setattr(facts, "partitions", lambda df: 3)
    assert held(spark, tmp_path, name)
    assert not re.search(r"l_linenumber#\d+ \+ 1", plan_queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString())
