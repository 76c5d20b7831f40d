"""Registered queries of what must hold at any size: bucketed writes, ranked keys, parsed records, ranges, scans, deep trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bitmaps, deep_tree, dims, facts, intervals, ranked, schema_sketch, sweep, variants
from tidemark.operators.semi import ExplodeSpec, Mapping
from tidemark.plans import spec
from tidemark.plans.queries import _ALLOCATED, _query, _sql_guid, _t
from tidemark.sources.buckets import BucketTable
from tidemark.sources.work import Scratch

# -- tables in buckets


@_query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS total,
CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN 'urgent' END AS batch FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 7 <> 0""")
def upsert_buckets(spark, sf):
    """All orders, urgent ones changed in a second version that is written twice, some low ones deleted."""
    orders, key = _t(spark, sf, "orders"), F.col("o_orderkey")
    table = BucketTable(spark, f"{Scratch(spark).root}/orders", ["o_orderkey"], 16)
    table.upsert(orders.select(key, F.col("o_totalprice").alias("total")))
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (key % 5 == 0)).select(key, F.round(F.col("o_totalprice") * 2, 2).alias("total"), F.lit("urgent").alias("batch"))
    for _ in range(2):
        table.upsert(urgent)
    table.delete(orders.where((F.col("o_orderpriority") == "5-LOW") & (key % 7 == 0)).select(key))
    return table.read()


@_query(f"""SELECT CAST(c_custkey AS VARCHAR) AS ck, c_mktsegment AS segment, {_sql_guid('c_custkey')} AS customer_key FROM customer
UNION ALL SELECT 'Unknown', 'n/a', {_sql_guid("'Unknown'")}""")
def guarded_build(spark, sf):
    """A dimension built and written in one pass: types, defaults, Unknown member, null and repeated keys."""
    rows = _t(spark, sf, "customer").select(F.col("c_custkey").alias("ck"), F.col("c_mktsegment").alias("segment"))
    table = BucketTable(spark, f"{Scratch(spark).root}/customers", ["ck"], 8)
    made = dims.TableSpec("dim_customer", merge_fields=["ck"], key="customer_key", defaults={"segment": ("string", "n/a")}, expected={"ck": "string", "segment": "string"})
    for _ in range(2):
        spec.merge_buckets(rows, made, table)
    return table.read()


# -- keys by rank


@_query("""WITH d AS (SELECT key, min(label) AS label FROM (SELECT 'S' || s_suppkey % 15 AS key, s_name AS label FROM supplier UNION ALL SELECT 'P' || p_partkey % 40, p_brand FROM part UNION ALL SELECT 'D' || n_nationkey, n_name FROM nation WHERE n_nationkey < 7) GROUP BY key),
f AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'S' || l_suppkey % 20 END AS a, CASE WHEN l_quantity > 25 THEN 'P' || l_partkey % 50 END AS b, 'D' || l_orderkey % 10 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(x.label, y.label, z.label) AS label, CASE WHEN x.key IS NOT NULL THEN 1 WHEN y.key IS NOT NULL THEN 2 WHEN z.key IS NOT NULL THEN 3 END AS place
FROM f LEFT JOIN d x ON x.key = a LEFT JOIN d y ON y.key = b LEFT JOIN d z ON z.key = c""")
def role_by_rank(spark, sf):
    text = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    known = _t(spark, sf, "supplier").select(text("S", F.col("s_suppkey") % 15).alias("key"), F.col("s_name").alias("label"))
    known = known.unionByName(_t(spark, sf, "part").select(text("P", F.col("p_partkey") % 40).alias("key"), F.col("p_brand").alias("label")))
    known = known.unionByName(_t(spark, sf, "nation").where("n_nationkey < 7").select(text("D", F.col("n_nationkey")).alias("key"), F.col("n_name").alias("label")))
    keys = [F.when(F.col("l_linenumber") % 3 == 0, text("S", F.col("l_suppkey") % 20)), F.when(F.col("l_quantity") > 25, text("P", F.col("l_partkey") % 50)), text("D", F.col("l_orderkey") % 10)]
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return ranked.resolve_ranked(rows, keys, known, "key", {"label": "label"}, "place").select("l_orderkey", "l_linenumber", "label", "place")


# -- JSON records


@_query("""SELECT CAST(conv_id AS VARCHAR) AS id, CAST(turn AS BIGINT) AS turn, role, CAST(length(text) AS INTEGER) AS n_chars,
CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN 'turn ' || turn ELSE role || ', ' || turn END AS label FROM conversations WHERE conv_id % 7 <> 0""")
def variant_records(spark, sf):
    """Turns of conversations from nested records, a label that is text, object or list, and records that are broken off."""
    label = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct("role"))).when(F.col("turn") % 3 == 1, F.concat(F.lit('"turn '), F.col("turn").cast("string"), F.lit('"'))).otherwise(F.to_json(F.array(F.col("role"), F.col("turn").cast("string"))))
    plain = F.to_json(F.struct("turn", "role", "text"))
    item = F.concat(F.substring(plain, 1, F.length(plain) - 1), F.lit(',"label":'), label, F.lit("}"))
    body = F.concat(F.lit('{"body":{"turns":['), F.array_join(F.collect_list(item), ","), F.lit('],"n":1},"id":'), F.col("conv_id").cast("string"), F.lit("}"))
    raw = _t(spark, sf, "conversations").groupBy("conv_id").agg(body.alias("raw_data"))
    raw = raw.select(F.when(F.col("conv_id") % 7 == 0, F.substring("raw_data", 1, 40)).otherwise(F.col("raw_data")).alias("raw_data"))
    shape = ExplodeSpec("body.turns", [Mapping("turn", "turn", "long"), Mapping("role", "role"), Mapping("text", "text")], "id", "id")
    rows = variants.explode_records(raw, shape, "item")
    return rows.select("id", "turn", "role", F.length("text").alias("n_chars"), variants.one_of_shapes(F.col("item"), "label", ["role"]).alias("label"))


@_query("""SELECT DISTINCT 'b' AS load_id, 'amount' AS path, 'widened' AS change, 'bigint' AS before, 'decimal' AS after FROM events WHERE event_id % 3 = 1 AND value <> floor(value)
UNION ALL SELECT DISTINCT 'b', 'note', 'added', NULL, 'object' FROM events WHERE event_id % 3 = 1
UNION ALL SELECT DISTINCT 'b', 'note.kind', 'added', NULL, 'string' FROM events WHERE event_id % 3 = 1
UNION ALL SELECT DISTINCT 'c', 'id', 'widened', 'bigint', 'string' FROM events WHERE event_id % 3 = 2
UNION ALL SELECT DISTINCT 'c', 'user', 'missing', 'bigint', NULL FROM events WHERE event_id % 3 = 2""")
def schema_drift(spark, sf):
    events = _t(spark, sf, "events")
    load = lambda k, *c: events.where(F.col("event_id") % 3 == "abc".index(k)).select(F.lit(k).alias("load_id"), F.to_json(F.struct(*c)).alias("raw_data"))
    user, note = F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("kind")).alias("note")
    records = [load("a", F.col("event_id").alias("id"), user, F.col("value").cast("long").alias("amount")), load("b", F.col("event_id").alias("id"), user, F.round("value", 4).cast("decimal(18,4)").alias("amount"), note), load("c", F.col("event_id").cast("string").alias("id"), F.col("value").cast("long").alias("amount"), note)]
    kept = [schema_sketch.sketch(r) for r in records]  # each load reads itself alone
    return schema_sketch.drift(kept[0].unionByName(kept[1]).unionByName(kept[2]), ["a", "b", "c"])


# -- ranges, scans, sweeps


@_query("""WITH r AS (SELECT s_suppkey, s_suppkey * 13 AS lo, s_suppkey * 13 + CASE WHEN s_suppkey % 50 = 0 THEN 1000000 ELSE [1, 10, 100, 1000, 10000][1 + s_suppkey % 5] END - 1 AS hi FROM supplier)
SELECT o_orderkey, count(s_suppkey) AS n, max(s_suppkey) AS last FROM orders LEFT JOIN r ON o_orderkey BETWEEN lo AND hi GROUP BY o_orderkey""")
def mixed_ranges(spark, sf):
    k = F.col("s_suppkey")
    length = F.when(k % 50 == 0, 1_000_000).otherwise(F.element_at(F.array(*[F.lit(10**i) for i in range(5)]), (k % 5 + 1).cast("int")))
    ranges = _t(spark, sf, "supplier").select(k, (k * 13).alias("lo"), (k * 13 + length - 1).alias("hi"))
    totals = {"n": ("s_suppkey", "count"), "last": ("s_suppkey", "max")}
    rows = intervals.range_totals(_t(spark, sf, "orders").select("o_orderkey"), ranges, "o_orderkey", "lo", "hi", totals)
    return rows.groupBy("o_orderkey").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


_HOT = "CASE WHEN event_id % 2 = 0 THEN 0 ELSE user_id END"


def _hot_events(spark, sf):
    """events, half of them in one key."""
    return _t(spark, sf, "events").withColumn("k", F.expr(_HOT).cast("long"))


@_query(f"""WITH e AS (SELECT event_id, {_HOT} AS k, ts, event_type FROM events), v AS (SELECT k, ts, max(event_id) AS version FROM e WHERE event_type = 'signup' GROUP BY ALL)
SELECT e.event_id, v.version FROM e ASOF LEFT JOIN v ON e.k = v.k AND e.ts >= v.ts""")
def as_of_hot_key(spark, sf):
    events = _hot_events(spark, sf)
    versions = events.where("event_type = 'signup'").groupBy("k", "ts").agg(F.max("event_id").alias("version"))
    return intervals.as_of_slices(events.select("event_id", "k", "ts"), versions, ["k"], "ts", "ts", ["version"]).select("event_id", "version")


@_query(f"""WITH o AS (SELECT {_HOT} AS k, ts, max(event_type) AS event_type, max(CASE WHEN event_id % 3 = 0 THEN value END) AS value FROM events GROUP BY ALL)
SELECT k, ts AS valid_from, lead(ts) OVER w AS valid_to, last_value(event_type IGNORE NULLS) OVER u AS state, last_value(value IGNORE NULLS) OVER u AS points, lead(ts) OVER w IS NULL AS is_current FROM o
WINDOW w AS (PARTITION BY k ORDER BY ts), u AS (PARTITION BY k ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
def state_periods_hot(spark, sf):
    log = _hot_events(spark, sf).select("k", "ts", F.col("event_type").alias("state"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("points"))
    return facts.state_periods_sliced(log, "k", "ts", ["state", "points"]).drop("is_seed")


@_query(f"""WITH {_ALLOCATED}, d AS (SELECT l_suppkey, day, sum(allocated) AS load FROM alloc GROUP BY ALL)
SELECT l_suppkey, CAST(count(*) FILTER (load > 5000) AS BIGINT) AS conflict_days, count(*) AS busy_days, round(max(load) + 0.00123, 2) AS peak FROM d GROUP BY l_suppkey""")
def load_steps(spark, sf):
    """What ``conflict_days`` counts by days, from interval ends alone."""
    day, role = F.to_date("l_shipdate"), F.struct("l_orderkey", "l_linenumber")
    rows = _t(spark, sf, "lineitem").select("l_suppkey", "l_partkey", role.alias("role"), (F.col("l_linenumber") % 2).alias("weight"), day.alias("a"), F.date_add(day, F.col("l_quantity").cast("int")).alias("b"), F.col("l_extendedprice").alias("hours"))
    each = sweep.interval_allocations(rows, "l_suppkey", "l_partkey", "role", "weight", "a", "b", "hours")
    steps = sweep.load_steps(each, ["l_suppkey"], "start", "end", "daily")
    return sweep.overload(steps, ["l_suppkey"], F.lit(5000.0)).withColumn("peak", F.round(F.col("peak") + 0.00123, 2))


# -- distinct counts and deep trees


@_query("""SELECT n_regionkey AS region, c_mktsegment AS segment, CAST(2 - grouping(n_regionkey) - grouping(c_mktsegment) AS INTEGER) AS level, count(DISTINCT o_custkey) AS customers
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_regionkey, c_mktsegment)""")
def distinct_matrix(spark, sf):
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(_t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    made = bitmaps.distinct_bitmaps(rows.select(F.col("n_regionkey").alias("region"), F.col("c_mktsegment").alias("segment"), "o_custkey"), "o_custkey", ["region", "segment"])
    return bitmaps.distinct_matrix(made, ["region", "segment"], "customers")


@_query("""WITH e AS (SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN CAST(ts AS DATE) END AS s, user_id FROM events)
SELECT id, CAST(CASE WHEN id % 2 = 0 THEN id // 2 ELSE id // 2 + 1 END AS BIGINT) AS depth, CASE WHEN id % 2 = 0 THEN min(s) OVER w ELSE s END AS first_start, CASE WHEN id % 2 = 0 THEN max(s) OVER w ELSE s END AS last_start,
CAST(CASE WHEN id % 2 = 0 THEN sum(user_id) OVER w ELSE user_id END AS BIGINT) AS users FROM e WINDOW w AS (ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def deep_rollup(spark, sf):
    """A chain of the even events, each with the odd one behind it as a leaf: half as deep as the table is long."""
    i = F.col("event_id")
    rows = _t(spark, sf, "events").select(i.alias("id"), F.when(i % 2 == 1, i - 1).when(i > 0, i - 2).alias("parent"), F.when(i % 10 == 0, F.to_date("ts")).alias("s"), "user_id")
    out = deep_tree.deep_rollup(rows, "id", "parent", {"first_start": ("s", "min"), "last_start": ("s", "max"), "users": ("user_id", "sum")})
    return out.select("id", "depth", "first_start", "last_start", "users")
