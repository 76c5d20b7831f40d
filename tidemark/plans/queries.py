"""Registered queries over the supplied tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.documents import rich_text, rich_text_flat
from tidemark.functions.keys import NAMESPACE, add_guid_key
from tidemark.operators import calendar, clean, dims, facts, history, intervals, recipes, semi, tree
from tidemark.plans import metrics
from tidemark.sources import landing, runlog, work

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def take(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return take


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sql_guid(*parts: str) -> str:
    name = " || '||' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    h = f"sha1(from_hex('{NAMESPACE}') || encode({name}))"
    return f"(substr({h},1,8)||'-'||substr({h},9,4)||'-5'||substr({h},14,3)||'-'||translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr({h},18,3)||'-'||substr({h},21,12))"


_CUSTOMER_DIM = f"SELECT CAST(c_custkey AS VARCHAR) AS ck, c_mktsegment AS segment, {_sql_guid('c_custkey')} AS customer_key FROM customer WHERE c_mktsegment <> 'MACHINERY'"


def _customer_dim(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("ck"), F.col("c_mktsegment").alias("segment"))
    return dims.build_table(rows, dims.TableSpec("dim_customer", merge_fields=["ck"], key="customer_key"))


@_query(f"SELECT c_custkey, {_sql_guid('c_custkey', 'c_mktsegment')} AS customer_key FROM customer")
def guid_key(spark, sf):
    return add_guid_key(_t(spark, sf, "customer"), ["c_custkey", "c_mktsegment"], "customer_key").select("c_custkey", "customer_key")


@_query(f"""
WITH d AS ({_CUSTOMER_DIM})
SELECT o_orderkey, coalesce(customer_key, {_sql_guid("'Unknown'")}) AS customer_key, customer_key IS NULL AS is_unknown
FROM orders LEFT JOIN d ON ck = CAST(o_custkey AS VARCHAR)""")
def unknown_lookup(spark, sf):
    dim = _customer_dim(spark, sf)
    orders = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("ck_in"))
    out = dims.lookup_key(orders, dim, "ck_in", "ck", "customer_key", default_to_unknown=True)
    return out.select("o_orderkey", "customer_key", (F.col("customer_key") == dims.unknown_key(dim, "ck", "customer_key")).alias("is_unknown"))


@_query(f"""
WITH d AS ({_CUSTOMER_DIM}),
x AS (SELECT o.*, coalesce(d.segment, 'Unknown') AS segment, CAST(o_orderdate AS DATE) AS d FROM orders o LEFT JOIN d ON ck = CAST(o_custkey AS VARCHAR))
SELECT CAST(year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, segment, round(sum(o_totalprice), 2) AS revenue, count(*) AS orders
FROM x GROUP BY ALL""")
def fiscal_revenue(spark, sf):
    """The flagship slice: orders with their customer resolved, by fiscal year and segment."""
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("ck_in"), F.to_date("o_orderdate").alias("day"), "o_totalprice")
    known = dims.lookup_key(orders, _customer_dim(spark, sf), "ck_in", "ck", "customer_key", default_to_unknown=True)
    ends = orders.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    days = calendar.date_dimension(spark, str(ends["a"]), str(ends["b"]), 4).select("date", "fiscal_year")
    star = metrics.Star(known, {"calendar": (days, "date", {"order": "day"}), "customer": (_customer_dim(spark, sf), "customer_key", {"buyer": "customer_key"})})
    rows = star.rows("calendar", "customer").withColumn("segment", F.coalesce("segment", F.lit("Unknown")))
    return rows.groupBy("fiscal_year", "segment").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count("*").alias("orders"))


@_query("""
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY ALL""")
def multi_role_lookup(spark, sf):
    rows = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(_t(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    sums = rows.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("r"))
    named = dims.lookup_keys(sums, _t(spark, sf, "nation"), {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"}, "n_nationkey", "n_name", default_to_unknown=False)
    return named.select("customer_nation", "supplier_nation", "n", F.round("r", 2).alias("revenue"))


@_query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS total, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 'new' END AS batch
FROM orders""")
def upsert_orders(spark, sf):
    orders = _t(spark, sf, "orders")
    old = orders.where("o_orderdate is null or o_orderdate < timestamp'1997-01-01'").select("o_orderkey", F.col("o_totalprice").alias("total"))
    new = orders.where("o_orderdate >= timestamp'1996-01-01'").select("o_orderkey", F.round(F.col("o_totalprice") * 2, 2).alias("total"), F.lit("new").alias("batch"))
    return history.upsert(history.upsert(old, new, ["o_orderkey"]), new, ["o_orderkey"])


def _snapshots(spark, sf):
    cust = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = _t(spark, sf, "orders")
    last = lambda rows: rows.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority")).join(cust, "c_custkey")
    return last(orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))), last(orders)


_SNAPSHOTS = """
a AS (SELECT o_custkey AS k, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1),
b AS (SELECT o_custkey AS k, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1)"""


@_query(f"""
WITH {_SNAPSHOTS}
SELECT a.k AS c_custkey, a.p AS priority, TIMESTAMP '1996-01-01' AS valid_from, CASE WHEN b.p <> a.p THEN TIMESTAMP '2000-01-01' END AS valid_to, NOT coalesce(b.p <> a.p, false) AS is_current FROM a LEFT JOIN b USING (k)
UNION ALL SELECT b.k, b.p, TIMESTAMP '2000-01-01', NULL, true FROM b LEFT JOIN a USING (k) WHERE a.k IS NULL OR a.p <> b.p""")
def scd2_snapshot(spark, sf):
    old, new = _snapshots(spark, sf)
    first = history.scd2_merge(None, old, ["c_custkey"], ["c_mktsegment", "priority"], "1996-01-01")
    return history.scd2_merge(first, new, ["c_custkey"], ["c_mktsegment", "priority"], "2000-01-01").select("c_custkey", "priority", "valid_from", "valid_to", "is_current")


@_query(f"""WITH {_SNAPSHOTS}
SELECT count(*) FILTER (a.k IS NULL) AS inserted, count(*) FILTER (a.p <> b.p) AS changed, count(*) FILTER (a.p = b.p) AS unchanged FROM b LEFT JOIN a USING (k)""")
def scd2_counts(spark, sf):
    old, new = _snapshots(spark, sf)
    first = history.scd2_merge(None, old, ["c_custkey"], ["c_mktsegment", "priority"], "1996-01-01")
    return history.scd2_counts(first, new, ["c_custkey"], ["c_mktsegment", "priority"])


_SIGNUPS = "SELECT user_id, ts, max(event_id) AS version FROM events WHERE event_type = 'signup' GROUP BY ALL"


@_query(f"""
SELECT e.event_id, v.version FROM events e ASOF LEFT JOIN ({_SIGNUPS}) v ON e.user_id = v.user_id AND e.ts >= v.ts""")
def as_of_versions(spark, sf):
    events = _t(spark, sf, "events")
    versions = events.where("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("event_id").alias("version"))
    return intervals.as_of_join(events.select("event_id", "user_id", "ts"), versions, ["user_id"], "ts", "ts", ["version"]).select("event_id", "version")


@_query(f"""
WITH v AS (SELECT user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to, version FROM ({_SIGNUPS}))
SELECT e.event_id, v.version FROM events e LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.valid_from AND (v.valid_to IS NULL OR e.ts < v.valid_to)""")
def as_of_lookup(spark, sf):
    events = _t(spark, sf, "events")
    once = events.where("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("event_id").alias("version"))
    periods = facts.state_periods(once, "user_id", "ts", ["version"]).select("user_id", "valid_from", "valid_to", "version")
    return dims.lookup_as_of(events, periods, "user_id", "user_id", "version", "ts").select("event_id", "version")


@_query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1")
def dedup_latest(spark, sf):
    return clean.dedup_latest(_t(spark, sf, "events"), ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "event_type")


@_query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1 AS is_latest FROM events")
def latest_flag(spark, sf):
    return facts.latest_flag(_t(spark, sf, "events"), ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]).select("event_id", "is_latest")


@_query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS gone FROM events")
def json_typed(spark, sf):
    maps = [semi.Mapping("k", "k", "long"), semi.Mapping("k_text", "k"), semi.Mapping("gone", "a.b")]
    return semi.map_columns(_t(spark, sf, "events"), maps, "props", ["event_id"])


@_query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark, sf):
    return semi.auto_standardize(_t(spark, sf, "events"), "props", carry=["event_id"]).select("event_id", "k")


def _threads(spark, sf):
    turns = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return turns.select(F.to_json(F.struct(F.col("conv_id").alias("id"), F.struct("turns").alias("body"))).alias("raw_data"))


@_query("SELECT CAST(conv_id AS VARCHAR) AS thread_id, turn, role, text AS said FROM conversations")
def json_explode(spark, sf):
    spec = semi.ExplodeSpec("body.turns", [semi.Mapping("turn", "turn", "long"), semi.Mapping("role", "role"), semi.Mapping("said", "text")], "thread_id", "id")
    return semi.explode_array(_threads(spark, sf), spec)


def _adf(spark, sf):
    node = F.struct(F.lit("text").alias("type"), F.col("text"))
    block = F.struct(F.lit("paragraph").alias("type"), F.array(node).alias("content"))
    docs = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", block.alias("b")))).alias("t"))
    return docs.select("conv_id", F.to_json(F.struct(F.lit("doc").alias("type"), F.transform("t", lambda x: x["b"]).alias("content"))).alias("doc"))


_ADF_SQL = "SELECT conv_id, nullif(string_agg(trim(text), chr(10) || chr(10) ORDER BY turn) FILTER (trim(text) <> ''), '') AS body FROM conversations GROUP BY conv_id"


@_query(_ADF_SQL)
def rich_text_native(spark, sf):
    return _adf(spark, sf).select("conv_id", rich_text_flat(F.col("doc")).alias("body"))


@_query(_ADF_SQL)
def rich_text_nested(spark, sf):
    return _adf(spark, sf).select("conv_id", rich_text(F.col("doc")).alias("body"))


@_query("""
SELECT count(*) AS n_rows, count(CASE WHEN trim(text) <> '' THEN 1 END) AS n_text, count(CASE WHEN trim(lang) <> '' THEN 1 END) AS n_lang,
       count(CASE WHEN trim(source) <> '' THEN 1 END) AS n_source, 0::BIGINT AS n_blank FROM documents""")
def clean_profile(spark, sf):
    docs = _t(spark, sf, "documents").withColumn("blank", F.when(F.col("doc_id") % 2 == 0, "  "))
    text = lambda c: F.count(F.when(F.trim(c) != "", 1))
    kept = clean.drop_empty_columns(docs)
    return docs.agg(F.count("*").alias("n_rows"), text("text").alias("n_text"), text("lang").alias("n_lang"), text("source").alias("n_source"), F.lit(len(set(kept.columns) & {"blank"})).cast("long").alias("n_blank"))


@_query(f"""
SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, strftime(d, '%b') AS month_short_name, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month,
       CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(date_trunc('week', d) AS DATE) + 6 AS week_end_date,
       strftime(date_trunc('week', d), '%b %Y') || ' ' || day(date_trunc('week', d)) || '-' || day(CAST(date_trunc('week', d) AS DATE) + 6) AS week_label,
       CAST(year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, CAST(((month(d) - 4 + 12) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders))""")
def date_dim(spark, sf):
    ends = _t(spark, sf, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")).first()
    return calendar.date_dimension(spark, str(ends["a"]), str(ends["b"]), 4)


def _work_calendar(spark, sf, region="uk"):
    ends = _t(spark, sf, "lineitem").agg(F.min(F.to_date("l_shipdate")).alias("a"), F.date_add(F.max(F.to_date("l_shipdate")), 120).alias("b")).first()
    days = calendar.date_dimension(spark, str(ends["a"]), str(ends["b"]))
    return calendar.working_calendar(days, calendar.holidays(spark, ends["a"].year, ends["b"].year, region))


#: Holidays in SQL by another Easter rule (the anonymous one), over the shipping years.
_HOLIDAYS = """
span AS (SELECT min(l_shipdate)::DATE AS lo, max(l_shipdate)::DATE + 120 AS hi FROM lineitem),
years AS (SELECT CAST(unnest(generate_series(year(lo), year(hi))) AS INTEGER) AS y FROM span),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS s FROM e3),
e5 AS (SELECT y, make_date(y, s // 31, s % 31 + 1) AS easter FROM e4),
f AS (SELECT y, make_date(y, 1, 1) AS n, make_date(y, 12, 25) AS x, make_date(y, 12, 26) AS z, make_date(y, 5, 1) AS m5, make_date(y, 5, 31) AS l5, make_date(y, 8, 31) AS l8, easter FROM e5),
hol AS (
 SELECT n + CASE isodow(n) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS d FROM f
 UNION SELECT x + CASE isodow(x) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END FROM f
 UNION SELECT z + CASE isodow(z) WHEN 6 THEN 2 WHEN 7 THEN 2 WHEN 1 THEN 1 ELSE 0 END FROM f
 UNION SELECT easter - 2 FROM f UNION SELECT easter + 1 FROM f
 UNION SELECT m5 + CAST((8 - isodow(m5)) % 7 AS INTEGER) FROM f
 UNION SELECT l5 - CAST(isodow(l5) - 1 AS INTEGER) FROM f UNION SELECT l8 - CAST(isodow(l8) - 1 AS INTEGER) FROM f
 UNION SELECT unnest([DATE '2022-06-02', DATE '2022-06-03', DATE '2022-09-19', DATE '2023-05-08'])),
cal AS (SELECT d, isodow(d) > 5 AS we, d IN (SELECT d FROM hol) AS ho FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span))"""


@_query(f"WITH {_HOLIDAYS} SELECT d AS date, ho AS is_holiday, NOT we AND NOT ho AS is_working_day FROM cal")
def holiday_flags(spark, sf):
    return _work_calendar(spark, sf).select("date", "is_holiday", "is_working_day")


@_query(f"""WITH {_HOLIDAYS}, w AS (SELECT d, NOT we AND NOT ho AS work, sum(CASE WHEN NOT we AND NOT ho THEN 1 ELSE 0 END) OVER (ORDER BY d) AS upto FROM cal),
x AS (SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS a, l_shipdate::DATE + CAST(l_quantity AS INTEGER) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST((wb.upto - wb.work::INTEGER) - (wa.upto - wa.work::INTEGER) AS BIGINT) AS working_days
FROM x JOIN w wa ON wa.d = x.a JOIN w wb ON wb.d = x.b""")
def working_days(spark, sf):
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("a"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("b"))
    return calendar.add_working_days(rows, "a", "b", _work_calendar(spark, sf)).select("l_orderkey", "l_linenumber", "working_days")


_ALLOCATED = """
s AS (SELECT l_suppkey, l_partkey, l_linenumber % 2 AS weight, l_shipdate::DATE AS a, l_shipdate::DATE + CAST(l_quantity AS INTEGER) AS b, l_extendedprice AS hours, l_orderkey FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_linenumber % 2 DESC, l_orderkey, l_linenumber) = 1),
x AS (SELECT *, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
alloc AS (SELECT *, hours / count(*) OVER (PARTITION BY l_suppkey, l_partkey) * weight AS allocated FROM x WHERE isodow(day) < 6)"""


def _allocations(spark, sf):
    role = F.struct("l_orderkey", "l_linenumber")
    rows = _t(spark, sf, "lineitem").select("l_suppkey", "l_partkey", role.alias("role"), (F.col("l_linenumber") % 2).alias("weight"), F.to_date("l_shipdate").alias("a"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("b"), F.col("l_extendedprice").alias("hours"))
    return facts.day_allocations(rows, "l_suppkey", "l_partkey", "role", "weight", "a", "b", "hours")


@_query(f"WITH {_ALLOCATED} SELECT l_suppkey, day AS alloc_date, count(*) AS items, round(sum(allocated) + 0.00123, 2) AS hours FROM alloc GROUP BY ALL")
def day_allocation(spark, sf):
    return _allocations(spark, sf).groupBy("l_suppkey", "alloc_block", "alloc_date").agg(F.count("*").alias("items"), F.round(F.sum("allocated_hours") + 0.00123, 2).alias("hours")).drop("alloc_block")


@_query(f"WITH {_ALLOCATED} SELECT l_suppkey, count(*) AS conflict_days FROM (SELECT l_suppkey, day FROM alloc GROUP BY ALL HAVING sum(allocated) > 5000) GROUP BY ALL")
def conflict_days(spark, sf):
    days = _allocations(spark, sf).withColumn("capacity", F.lit(5000.0))
    return metrics.conflict_days(days, "l_suppkey", "alloc_date", "allocated_hours", "capacity", "alloc_block").groupBy("l_suppkey").agg(F.count("*").alias("conflict_days"))


@_query(f"""WITH {_ALLOCATED} SELECT l_suppkey, CAST(date_trunc('week', day) AS DATE) AS period, count(DISTINCT l_partkey) AS load,
CASE WHEN count(DISTINCT l_partkey) > 8 THEN 'over' WHEN count(DISTINCT l_partkey) > 4 THEN 'busy' ELSE 'free' END AS load_band, strftime(date_trunc('week', day), '%b %Y') AS span FROM alloc GROUP BY ALL""")
def capacity_grid(spark, sf):
    return metrics.capacity_grid(_allocations(spark, sf), "l_suppkey", "alloc_date", "week", F.count_distinct("l_partkey"), 4, 8, "alloc_block")


@_query(f"""WITH {_ALLOCATED}, lo AS (SELECT min(day) AS d FROM alloc)
SELECT l_suppkey, strftime(day, '%Y-%m-%d') AS day, count(DISTINCT l_partkey) AS n FROM alloc, lo WHERE day >= d AND day < d + 15 AND isodow(day) < 6 GROUP BY ALL""")
def day_grid(spark, sf):
    rows = _allocations(spark, sf)
    first = str(rows.agg(F.min("alloc_date")).first()[0])
    return metrics.day_pivot(rows, "l_suppkey", "alloc_date", first, 15, F.count_distinct("l_partkey"))


def _heap(spark, sf):
    """events as a 4-ary heap: id 0 is the root."""
    day = F.to_date("ts")
    return _t(spark, sf, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") > 0, F.floor((F.col("event_id") - 1) / 4)).alias("parent"), F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("code"), F.lpad(F.col("event_id").cast("string"), 9, "0").alias("rank"), F.when(F.col("event_id") % 10 == 0, day).alias("start"), F.when(F.col("event_id") % 10 == 0, F.date_add(day, 3)).alias("end"), (F.col("event_id") % 3).cast("int").alias("kind"))


_HEAP = """RECURSIVE h AS (SELECT event_id AS id, CASE WHEN event_id > 0 THEN (event_id - 1) // 4 END AS parent, 'E' || event_id AS code, lpad(CAST(event_id AS VARCHAR), 9, '0') AS rank,
  CASE WHEN event_id % 10 = 0 THEN ts::DATE END AS s, CASE WHEN event_id % 10 = 0 THEN ts::DATE + 3 END AS e, event_id % 3 AS kind FROM events),
c(node, ancestor, distance) AS (SELECT id, id, 0 FROM h UNION ALL SELECT c.node, h.parent, c.distance + 1 FROM c JOIN h ON h.id = c.ancestor JOIN h p ON p.id = h.parent)"""


@_query(f"""WITH {_HEAP}, l AS (SELECT node, list(h.code ORDER BY distance DESC) AS a FROM c JOIN h ON h.id = ancestor GROUP BY node)
SELECT node AS id, {', '.join(f'a[{i}] AS level_{i}' for i in range(1, 13))} FROM l""")
def dense_levels(spark, sf):
    return tree.dense_levels(_heap(spark, sf).select("id", "parent", "code"), "id", "parent", "code", 12, any_depth=True).select("id", *[f"level_{i}" for i in range(1, 13)])


@_query(f"""WITH {_HEAP}, k AS (SELECT c.node, c.distance, a.code, a.kind + 1 AS lv, n.kind + 1 AS own FROM c JOIN h a ON a.id = c.ancestor JOIN h n ON n.id = c.node)
SELECT node AS id, {', '.join(f'arg_min(code, distance) FILTER (lv = {i}) AS level_{i}' for i in (1, 2, 3))} FROM k WHERE distance = 0 OR lv < own GROUP BY node""")
def typed_levels(spark, sf):
    return tree.typed_levels(_heap(spark, sf), "id", "parent", "code", "kind", {0: 1, 1: 2, 2: 3}).select("id", "level_1", "level_2", "level_3")


@_query(f"WITH {_HEAP} SELECT node AS id, string_agg(h.rank, '!' ORDER BY distance DESC) AS sort_path, CAST(max(distance) AS INTEGER) AS depth FROM c JOIN h ON h.id = ancestor GROUP BY node")
def sort_path(spark, sf):
    return tree.sort_paths(_heap(spark, sf), "id", "parent", "rank", None).select("id", "sort_path", "depth")


_ROLLED = f"""WITH {_HEAP}, r AS (SELECT ancestor, min(s) AS s, max(e) AS e FROM c JOIN h ON h.id = c.node GROUP BY ancestor)
SELECT h.id, coalesce(h.s, r.s) AS rolled_start, coalesce(h.e, r.e) AS rolled_end, h.s IS NOT NULL AS has_own_dates FROM h LEFT JOIN r ON r.ancestor = h.id"""


@_query(_ROLLED)
def rollup_walk(spark, sf):
    return tree.rollup_dates(_heap(spark, sf), "id", "parent", "start", "end").select("id", "rolled_start", "rolled_end", "has_own_dates")


@_query(_ROLLED)
def rollup_path(spark, sf):
    paths = tree.sort_paths(_heap(spark, sf), "id", "parent", "rank", None)
    return tree.rollup_dates_by_path(paths, "sort_path", "start", "end").select("id", "rolled_start", "rolled_end", "has_own_dates")


@_query(f"""WITH {_HEAP}, p AS (SELECT node AS id, string_agg(h.rank, '!' ORDER BY distance DESC) AS path, max(distance) AS depth FROM c JOIN h ON h.id = ancestor GROUP BY node),
k AS (SELECT * FROM p WHERE depth <> 2)
SELECT k.id, q.path AS parent_path, CAST(CASE WHEN k.depth > 2 THEN k.depth - 1 ELSE k.depth END AS INTEGER) AS depth
FROM k LEFT JOIN p q ON q.path = array_to_string(string_split(k.path, '!')[1:CASE WHEN k.depth = 3 THEN 2 ELSE k.depth END], '!') AND k.depth > 0""")
def tree_rebuild(spark, sf):
    paths = tree.sort_paths(_heap(spark, sf), "id", "parent", "rank", None).where("depth <> 2").select("id", "sort_path")
    return tree.rebuild_tree(paths, "id", "sort_path").select("id", "parent_path", "depth")


_PERIODS = """
o AS (SELECT user_id, ts, max(event_type) AS event_type, max(CASE WHEN event_id % 3 = 0 THEN value END) AS value FROM events GROUP BY ALL),
p AS (SELECT user_id, ts AS valid_from, lead(ts) OVER w AS valid_to, last_value(event_type IGNORE NULLS) OVER u AS state, last_value(value IGNORE NULLS) OVER u AS points FROM o
      WINDOW w AS (PARTITION BY user_id ORDER BY ts), u AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING))"""


def _periods(spark, sf):
    log = _t(spark, sf, "events").select("user_id", "ts", F.col("event_type").alias("state"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("points"))
    return facts.state_periods(log, "user_id", "ts", ["state", "points"])


@_query(f"WITH {_PERIODS} SELECT user_id, valid_from, valid_to, state, points, valid_to IS NULL AS is_current FROM p")
def state_periods(spark, sf):
    return _periods(spark, sf).select("user_id", "valid_from", "valid_to", "state", "points", "is_current")


@_query(f"""WITH {_PERIODS}, d AS (SELECT state, greatest(0.0::DOUBLE, (epoch(coalesce(valid_to, CASE WHEN state = 'purchase' THEN valid_from END, TIMESTAMP '2030-01-01'))::BIGINT - epoch(valid_from)::BIGINT) / 86400.0::DOUBLE) AS days,
 lag(state = 'purchase') OVER (PARTITION BY user_id ORDER BY valid_from) AND state <> 'purchase' AS re FROM (SELECT * REPLACE (date_trunc('second', valid_from) AS valid_from, date_trunc('second', valid_to) AS valid_to), valid_from AS vf FROM p))
SELECT state, count(*) AS periods, round(sum(days), 2) AS total_days, round(avg(days), 4) AS avg_days, count(*) FILTER (re) AS reopened FROM d GROUP BY state""")
def days_in_state(spark, sf):
    done = F.col("state") == "purchase"
    closed = facts.flag_reopened(facts.close_done(_periods(spark, sf), done, F.col("valid_from"), "2030-01-01"), "user_id", done)
    return closed.groupBy("state").agg(F.count("*").alias("periods"), F.round(F.sum("days_in_period"), 2).alias("total_days"), F.round(F.avg("days_in_period"), 4).alias("avg_days"), metrics.count_where(F.col("is_reopen")).alias("reopened"))


@_query("""WITH r AS (SELECT CAST(row_number() OVER (ORDER BY lo) AS BIGINT) AS register_no, lo, hi FROM (SELECT DISTINCT o_orderkey // 100 * 100 AS lo, o_orderkey // 100 * 100 + 79 AS hi FROM orders))
SELECT l_orderkey, l_linenumber, lo AS register_from FROM lineitem LEFT JOIN r ON l_orderkey BETWEEN lo AND hi""")
def register_range(spark, sf):
    registers = _t(spark, sf, "orders").select((F.floor(F.col("o_orderkey") / 100) * 100).alias("register_from")).distinct().withColumn("register_to", F.col("register_from") + 79)
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return intervals.join_points(rows, registers, "l_orderkey", "register_from", "register_to", 100).select("l_orderkey", "l_linenumber", "register_from")


@_query("SELECT user_id, " + ", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in ("click", "view", "signup", "purchase")) + " FROM events GROUP BY user_id")
def conditional_pivot(spark, sf):
    return recipes.pivot_values(_t(spark, sf, "events"), ["user_id"], "event_type", "value", {t: t for t in ("click", "view", "signup", "purchase")})


_LINKS = """
pairs AS (SELECT DISTINCT a.l_partkey AS x, b.l_partkey AS y FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1 WHERE a.l_partkey <> b.l_partkey),
links AS (SELECT x AS item, y AS linked, CASE WHEN x % 2 = 0 THEN 'Blocks' ELSE 'Relates' END AS t, 'Outward' AS direction, CASE WHEN x % 2 = 0 THEN 'blocks' ELSE 'relates to' END AS label FROM pairs
  UNION ALL SELECT y, x, CASE WHEN x % 2 = 0 THEN 'Blocks' ELSE 'Relates' END, 'Inward', CASE WHEN x % 2 = 0 THEN 'is blocked by' ELSE 'relates to' END FROM pairs),
blocked AS (SELECT DISTINCT y AS item FROM pairs WHERE x % 2 = 0),
bridge AS (SELECT DISTINCT CAST(item AS VARCHAR) AS item, CAST(linked AS VARCHAR) AS linked, t AS link_type, direction, label, item IN (SELECT item FROM blocked) AS has_blocker FROM links
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), '(none)', 'Blocks', 'Inward', 'is blocked by', false FROM part WHERE p_partkey NOT IN (SELECT item FROM blocked))"""


def _pairs(spark, sf):
    """Neighbouring lines' parts, each pair once, written: links and what blocks are read from them several times."""
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    n = work.partitions(lines)
    a = lines.select("l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"), F.col("l_partkey").alias("x")).repartition(n, "l_orderkey", "l_linenumber")
    b = lines.withColumnRenamed("l_partkey", "y").repartition(n, "l_orderkey", "l_linenumber")
    return work.Scratch(spark).keep(a.join(b, ["l_orderkey", "l_linenumber"]).where("x <> y").select("x", "y").repartition(n, "x", "y").distinct())


def _bridge(spark, sf, pairs=None):
    pairs = (_pairs(spark, sf) if pairs is None else pairs).select(F.col("x").cast("string").alias("x"), F.col("y").cast("string").alias("y"), (F.col("x") % 2 == 0).alias("even"))
    kind = F.when(F.col("even"), "Blocks").otherwise("Relates").alias("link_type")
    labels = [F.when(F.col("even"), "blocks").otherwise("relates to").alias("outward_label"), F.when(F.col("even"), "is blocked by").otherwise("relates to").alias("inward_label")]
    none = F.lit(None).cast("string")
    links = pairs.select(F.col("x").alias("item"), F.col("y").alias("outward"), none.alias("inward"), kind, *labels).unionByName(pairs.select(F.col("y").alias("item"), none.alias("outward"), F.col("x").alias("inward"), kind, *labels))
    return facts.link_bridge(links, _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("item")), "item")


@_query(f"WITH {_LINKS} SELECT * FROM bridge")
def link_bridge(spark, sf):
    return _bridge(spark, sf).select("item", "linked", "link_type", "direction", "label", "has_blocker")


@_query(f"WITH {_LINKS} SELECT label, direction, count(*) AS links, count(DISTINCT item) AS items FROM bridge WHERE linked <> '(none)' GROUP BY ALL")
def link_table(spark, sf):
    return _bridge(spark, sf).where("linked <> '(none)'").groupBy("label", "direction").agg(F.count("*").alias("links"), F.count_distinct("item").alias("items"))


@_query("""WITH l AS (SELECT DISTINCT l_suppkey AS resource, l_partkey AS item FROM lineitem WHERE l_linenumber = 1), i AS (SELECT DISTINCT l_suppkey AS resource, l_partkey AS item FROM lineitem)
SELECT resource, item, 'lead' AS role, 1 AS weight FROM l UNION ALL SELECT i.*, 'involved', 0 FROM i ANTI JOIN l USING (resource, item)""")
def allocation_roles(spark, sf):
    rows = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("resource"), F.col("l_partkey").alias("item"), "l_linenumber")
    return facts.role_allocations(rows.where("l_linenumber = 1"), rows, "resource", "item")


@_query("""SELECT c_mktsegment AS segment, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'F')::DOUBLE / count(*) AS share,
count(*) FILTER (o_totalprice < 0)::DOUBLE / nullif(count(*) FILTER (o_totalprice < -1), 0) AS blank FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL""")
def coverage(spark, sf):
    star = metrics.Star(_t(spark, sf, "orders"), {"customer": (_t(spark, sf, "customer"), "c_custkey", {"buyer": "o_custkey"})})
    done, n = metrics.count_where(F.col("o_orderstatus") == "F"), F.count("*")
    blank = metrics.share(metrics.count_where(F.col("o_totalprice") < 0), metrics.count_where(F.col("o_totalprice") < -1))
    out = star.measure(["c_mktsegment"], {"orders": n, "finished": done, "share": metrics.share(done, n), "blank": blank}, ["customer"])
    return out.withColumnRenamed("c_mktsegment", "segment")


@_query("SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ROLLUP (1, 2)")
def matrix_totals(spark, sf):
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.rollup(F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@_query("""SELECT o_orderpriority AS name, CAST(CASE WHEN o_orderpriority ILIKE '%high%' THEN 2 WHEN o_orderpriority ILIKE '%medium%' THEN 3 WHEN o_orderpriority ILIKE '%low%' THEN 4 ELSE 9 END AS INTEGER) AS sort_order,
CASE WHEN o_orderpriority ILIKE '%high%' THEN 'High' WHEN o_orderpriority ILIKE '%medium%' THEN 'Medium' WHEN o_orderpriority ILIKE '%low%' THEN 'Low' ELSE 'Unknown' END AS band, count(*) AS n FROM orders GROUP BY ALL""")
def keyword_band(spark, sf):
    rows = _t(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("n"))
    return recipes.keyword_bands(rows, "name").select("name", "sort_order", "band", "n")


@_query("SELECT event_type, CASE event_type WHEN 'view' THEN 'Look' WHEN 'click' THEN 'Look' WHEN 'purchase' THEN 'Buy' ELSE 'Other' END AS stage, event_type IN ('view', 'click', 'purchase') AS is_mapped, count(*) AS n FROM events GROUP BY ALL")
def vocabulary_map(spark, sf):
    words = recipes.vocabulary(spark, {"Look": ["View", " click"], "Buy": ["purchase", "view"]})
    rows = _t(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return recipes.map_vocabulary(rows, "event_type", words, F.lit("Other")).select("event_type", "stage", "is_mapped", "n")


def _log(spark, sf):
    return _t(spark, sf, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("step_name"), F.when(F.col("value") > 20, "succeeded").otherwise("failed").alias("status"), F.col("ts").alias("logged_at"))


@_query("""SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS step_name, arg_max(CASE WHEN value > 20 THEN 'succeeded' ELSE 'failed' END, (ts, CASE WHEN value > 20 THEN 'succeeded' ELSE 'failed' END)) AS status, max(ts) AS logged_at FROM events GROUP BY ALL""")
def run_log(spark, sf):
    return runlog.latest_steps(_log(spark, sf))


@_query("SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M') AS last_watermark FROM events GROUP BY ALL")
def watermark(spark, sf):
    raw = _t(spark, sf, "events").select("event_type", F.to_json(F.struct(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("updated")).alias("fields"))).alias("raw_data"))
    return landing.new_watermark(raw, "fields.updated", "1900-01-01 00:00", ["event_type"])


@_query("""WITH p AS (SELECT event_type AS entity, user_id // 20 AS page_no, count(*) AS n FROM events GROUP BY ALL), s AS (SELECT entity, max(page_no) AS page_no, CAST(sum(n) AS BIGINT) AS seen, arg_max(n, page_no) AS last FROM p GROUP BY entity)
SELECT entity, page_no, seen, last < 20 AS is_complete FROM s""")
def page_check(spark, sf):
    pages = _t(spark, sf, "events").groupBy(F.col("event_type").alias("entity"), F.floor(F.col("user_id") / 20).alias("page_no")).agg(F.to_json(F.struct(F.collect_list(F.struct("event_id")).alias("items"))).alias("body"))
    return landing.check_pages(pages, 20, records_path="items")


@_query("SELECT CAST(event_id AS VARCHAR) AS primary_key, 'app' AS source_system, 'event' AS entity, CAST(ts AS DATE) AS ingest_date FROM events")
def land_envelope(spark, sf):
    rows = _t(spark, sf, "events").select(F.col("event_id").alias("id"), "user_id", "ts")
    return landing.envelope(rows.withColumn("_raw", F.to_json(F.struct("id", "user_id"))), "app", "event", "load-1", "id", F.col("ts"), "_raw").select("primary_key", "source_system", "entity", "ingest_date")


@_query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'")
def incremental_slice(spark, sf):
    return landing.slice_since(_t(spark, sf, "orders"), "o_orderdate", "1997-06-01").select("o_orderkey", "o_orderpriority")


@_query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ', ') AS kinds, count(DISTINCT event_type) AS n FROM events GROUP BY user_id")
def joined_list(spark, sf):
    rows = _t(spark, sf, "events")
    return recipes.joined_list(rows, ["user_id"], "event_type", "kinds").join(rows.groupBy("user_id").agg(F.count_distinct("event_type").alias("n")), "user_id")


@_query("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 ORDER BY s_suppkey")
def listed_rows(spark, sf):
    return metrics.listed(_t(spark, sf, "supplier"), F.col("s_acctbal") > 0, ["s_suppkey", "s_name"], [F.col("s_suppkey")])


@_query("SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#11' AND lower(p_brand) LIKE '%brand#%'")
def slicer_values(spark, sf):
    return metrics.slicer(_t(spark, sf, "part"), "p_brand", unlike=["Brand#11"], contains="Brand#")


@_query("SELECT l_suppkey AS resource, CAST(sum(w) AS BIGINT) AS load, sum(w) > 5 AS is_overallocated FROM (SELECT DISTINCT l_suppkey, l_partkey, max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey, l_partkey) AS w FROM lineitem) GROUP BY ALL")
def overallocated(spark, sf):
    rows = allocation_roles(spark, sf).withColumn("capacity", F.lit(5))
    return metrics.overallocated(rows, "resource", "weight", "capacity").select("resource", "load", "is_overallocated")


@_query("""SELECT sn.n_name AS nation, 'billed' AS role, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation sn ON sn.n_nationkey = c_nationkey GROUP BY ALL
UNION ALL SELECT n.n_name, 'keyed', count(*) FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation n ON n.n_nationkey = o_orderkey % 25 GROUP BY ALL""")
def inactive_relationship(spark, sf):
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).withColumn("other", (F.col("o_orderkey") % 25).cast("int"))
    star = metrics.Star(rows, {"nation": (_t(spark, sf, "nation"), "n_nationkey", {"billed": "c_nationkey", "keyed": "other"})})
    made = [star.measure(["n_name"], {"n": F.count("*")}, ["nation"], roles={"nation": r}).withColumn("role", F.lit(r)) for r in ("billed", "keyed")]
    return made[0].unionByName(made[1]).withColumnRenamed("n_name", "nation")


from tidemark.plans import detail_queries, item_queries, scale_queries  # noqa: E402,F401  register more queries in the tables above
