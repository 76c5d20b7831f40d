"""Registered queries for seeds and ages of periods, statuses of links, dimensions in full, pages, child rows and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.documents import unquoted
from tidemark.functions.keys import add_parent_key
from tidemark.operators import calendar, facts, recipes, semi, tree, variants
from tidemark.operators.semi import ExplodeSpec, Mapping
from tidemark.plans import metrics
from tidemark.plans.queries import _HEAP, _LINKS, _bridge, _heap, _pairs, _query, _sql_guid, _t, allocation_roles
from tidemark.sources import landing, sinks
from tidemark.sources.work import Scratch, partitions
from tidemark.streaming.landing import windowed_counts

_THIRD = "o_orderkey % 3 = 0"


@_query(f"""WITH log AS (SELECT o_custkey AS k, o_orderdate AS t, o_orderpriority AS state, o_orderstatus AS old_state, CASE WHEN {_THIRD} THEN o_totalprice END AS points, CASE WHEN {_THIRD} THEN o_totalprice / 2 END AS old_points FROM orders),
f AS (SELECT k, arg_min(old_state, (t, state, old_state)) AS s, arg_min(old_points, (t, points, old_points)) FILTER (points IS NOT NULL) AS p FROM log GROUP BY k),
o AS (SELECT k, t, max(state) AS state, max(points) AS points, max(seed) = 1 AS is_seed FROM (
  SELECT c_custkey AS k, TIMESTAMP '1990-01-01' AS t, coalesce(s, c_mktsegment) AS state, coalesce(p, c_acctbal) AS points, 1 AS seed FROM customer LEFT JOIN f ON k = c_custkey
  UNION ALL SELECT k, t, state, points, 0 FROM log) GROUP BY ALL)
SELECT k, t AS valid_from, lead(t) OVER w AS valid_to, last_value(state IGNORE NULLS) OVER u AS state, last_value(points IGNORE NULLS) OVER u AS points, is_seed, lead(t) OVER w IS NULL AS is_current FROM o
WINDOW w AS (PARTITION BY k ORDER BY t), u AS (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING)""")
def seeded_periods(spark, sf):
    """Orders as the change log of their customers, each of which began in a state that no row names."""
    third = F.expr(_THIRD)
    log = _t(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("state"), F.col("o_orderstatus").alias("old_state"), F.when(third, F.col("o_totalprice")).alias("points"), F.when(third, F.col("o_totalprice") / 2).alias("old_points"))
    entities = _t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.lit("1990-01-01").cast("timestamp").alias("created"), "c_mktsegment", "c_acctbal")
    seeds = facts.first_states(entities, log, "k", "created", "at", {"state": ("old_state", "c_mktsegment"), "points": ("old_points", "c_acctbal")})
    events = seeds.unionByName(log.select("k", "at", "state", "points", F.lit(False).alias("is_seed")))
    return facts.state_periods(events, "k", "at", ["state", "points"], "is_seed")


@_query("""WITH e AS (SELECT user_id, date_trunc('second', ts) AS ts, max(event_type) AS state FROM events GROUP BY ALL),
p AS (SELECT user_id, ts AS valid_from, state, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM e),
q AS (SELECT *, CASE WHEN state = 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN valid_from + INTERVAL 36 HOUR ELSE valid_from END END AS done,
  CASE WHEN state = 'view' AND user_id % 5 > 0 THEN greatest(valid_from, CAST(CAST(valid_from AS DATE) + CAST(user_id % 5 AS INTEGER) AS TIMESTAMP)) ELSE valid_from END AS began FROM p),
r AS (SELECT *, coalesce(next, done) AS valid_to, coalesce(next, done, TIMESTAMP '2030-01-01') AS counted FROM q),
w AS (SELECT d, count(*) FILTER (isodow(d) < 6 AND NOT (month(d) = 12 AND day(d) = 25)) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2031-12-31', INTERVAL 1 DAY)) AS DATE) AS d))
SELECT user_id, valid_from, valid_to, CAST(greatest(0, epoch(counted) - epoch(began)) AS BIGINT) AS seconds, CAST(greatest(b.n - a.n, 0) AS BIGINT) AS working_days
FROM r LEFT JOIN w a ON a.d = CAST(began AS DATE) LEFT JOIN w b ON b.d = CAST(counted AS DATE) + CASE WHEN next IS NULL THEN 1 ELSE 0 END""")
def aged_periods(spark, sf):
    days = calendar.date_dimension(spark, "2015-01-01", "2031-12-31")
    work = calendar.working_calendar(days, days.where("month = 12 and day_of_month = 25").select("date"))
    log = _t(spark, sf, "events").select("user_id", F.date_trunc("second", "ts").alias("ts"), F.col("event_type").alias("state"))
    periods = facts.state_periods(log, "user_id", "ts", ["state"])
    user, planned = F.col("user_id"), F.date_add(F.to_date("valid_from"), (F.col("user_id") % 5).cast("int"))
    resolved = F.when(user % 2 == 0, F.col("valid_from") + F.expr("interval 36 hours"))
    aged = facts.aged_periods(periods, F.col("state") == "view", F.when(user % 5 > 0, planned), F.col("state") == "purchase", resolved, "2030-01-01", work)
    return aged.select("user_id", "valid_from", "valid_to", F.round(F.col("days_in_period") * 86400).cast("long").alias("seconds"), "working_days")


_TRACKED = "CASE l_returnflag WHEN 'A' THEN 'passed' WHEN 'R' THEN 'blocked' ELSE 'aborted' END"


@_query(f"""WITH {_LINKS}, runs AS (SELECT CAST(l_partkey AS VARCHAR) AS t, {_TRACKED} AS s, l_shipdate AS a, l_orderkey * 10 + l_linenumber AS run_id FROM lineitem),
latest AS (SELECT t, CASE s WHEN 'passed' THEN 'Passed' WHEN 'blocked' THEN 'Blocked' END AS s FROM runs QUALIFY row_number() OVER (PARTITION BY t ORDER BY a DESC NULLS LAST, run_id DESC) = 1)
SELECT b.item, b.linked, b.link_type, b.direction, coalesce(l.s, 'Unknown') AS linked_status, coalesce(i.s, 'N/A') AS item_status, b.has_blocker, coalesce(i.s, '') = 'Blocked' AND NOT b.has_blocker AS lacks_blocker
FROM bridge b LEFT JOIN latest l ON l.t = b.linked LEFT JOIN latest i ON i.t = b.item""")
def link_statuses(spark, sf):
    lines, part = _t(spark, sf, "lineitem"), F.col("l_partkey").cast("string")
    runs = lines.select(part.alias("test"), F.expr(_TRACKED).alias("status_name"), F.col("l_shipdate").alias("started_on"), F.lit(None).cast("timestamp").alias("finished_on"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run_id"))
    named = lines.where("l_returnflag in ('A', 'R')").select(F.when(F.col("l_returnflag") == "A", "PASSED").otherwise("BLOCKED").alias("name"), F.lit("used").alias("description"))
    statuses = recipes.test_status_dimension(named, "name", "description")
    pairs = _pairs(spark, sf)
    out = facts.with_test_statuses(_bridge(spark, sf, pairs), runs, statuses, "item", "test", 2 * partitions(pairs))
    return out.select("item", "linked", "link_type", "direction", "linked_status", "item_status", "has_blocker", "lacks_blocker")


_NAMES = "CASE event_type WHEN 'purchase' THEN 'PASSED' WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'BLOCKED' WHEN 'click' THEN 'TO DO' ELSE upper(event_type) END"


@_query(f"""WITH n AS (SELECT {_NAMES} AS name, min(CASE WHEN event_type <> 'view' THEN event_type END) AS description FROM events GROUP BY 1)
SELECT upper(name[1]) || lower(name[2:]) AS status, coalesce(description, 'Unknown') AS description, CASE name WHEN 'PASSED' THEN 'Passed' WHEN 'FAILED' THEN 'Failed' WHEN 'BLOCKED' THEN 'Blocked' ELSE 'Not run' END AS coverage,
CAST(CASE name WHEN 'PASSED' THEN 1 WHEN 'FAILED' THEN 2 WHEN 'BLOCKED' THEN 3 WHEN 'EXECUTING' THEN 4 WHEN 'TO DO' THEN 5 ELSE 9 END AS INTEGER) AS sort_order, false AS is_not_run,
name IN ('PASSED', 'FAILED') AS is_final, name = 'PASSED' AS is_pass, name = 'FAILED' AS is_fail, name = 'BLOCKED' AS is_blocked FROM n
UNION ALL SELECT 'Not run', 'Test has not been executed yet', 'Not run', 6, true, false, false, false, false""")
def tracker_dimension(spark, sf):
    rows = _t(spark, sf, "events").select(F.expr(_NAMES).alias("name"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("description"))
    return recipes.test_status_dimension(rows, "name", "description")


_TIERS = {1: "epic", 2: "story", 3: "task"}


@_query(f"""WITH {_HEAP}, l AS (SELECT node, list(h.code ORDER BY distance DESC) AS a, string_agg(h.rank, '!' ORDER BY distance DESC) AS path, CAST(count(*) AS INTEGER) AS depth FROM c JOIN h ON h.id = ancestor GROUP BY node),
k AS (SELECT c.node, c.distance, a.code, a.kind + 1 AS lv, n.kind + 1 AS own FROM c JOIN h a ON a.id = c.ancestor JOIN h n ON n.id = c.node),
t AS (SELECT node, {', '.join(f'arg_min(code, distance) FILTER (lv = {i}) AS {n}' for i, n in _TIERS.items())} FROM k WHERE distance = 0 OR lv < own GROUP BY node)
SELECT h.id, h.code, s IS NULL OR e IS NULL AS missing_dates, CASE WHEN h.id % 5 = 0 THEN least('E' || (h.id + 1), 'E' || (h.id + 2)) || ', ' || greatest('E' || (h.id + 1), 'E' || (h.id + 2)) ELSE 'None' END AS predecessors, coalesce('U' || CASE WHEN h.id % 2 = 0 THEN user_id END, 'None') AS people,
CASE WHEN h.id % 3 = 1 THEN event_type END AS test_type, CASE WHEN parent IS NOT NULL THEN {_sql_guid('parent')} END AS parent_key, epic, story, task, a[1] AS level_1, a[4] AS level_4, depth, path AS sort_path, CAST(NULL AS VARCHAR) AS sprint
FROM h JOIN l ON l.node = h.id JOIN t ON t.node = h.id JOIN events ON event_id = h.id""")
def work_items(spark, sf):
    events, i = _t(spark, sf, "events"), F.col("event_id")
    named = lambda c: F.concat(F.lit("E"), c.cast("string"))
    before = events.where("event_id % 5 = 0").select(i.alias("id"), F.explode(F.array(named(i + 2), named(i + 1), named(i + 1))).alias("linked"))
    persons = events.where("event_id % 2 = 0").select(i.alias("id"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("person"))
    tests = events.where("event_id % 3 = 1").select(i.alias("id"), F.col("event_type").alias("test_type"))
    items = _heap(spark, sf).withColumnRenamed("kind", "type_rank")
    wanted = ["id", "code", "missing_dates", "predecessors", "people", "test_type", "parent_key", *_TIERS.values(), "level_1", "level_4", "depth", "sort_path", "sprint"]
    return recipes.work_items(items, before, persons, tests, wanted, levels={0: 1, 1: 2, 2: 3}, tiers=_TIERS, max_depth=12, any_depth=True)


@_query("""SELECT o_orderkey, o_orderpriority || ': ' || o_orderstatus AS label, o_orderdate = o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) AS is_milestone FROM orders WHERE o_orderkey % 7 > 0 AND o_orderkey % 4 > 0""")
def gantt_labels(spark, sf):
    """Planned orders that are no milestones."""
    day = F.to_date("o_orderdate")
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"), F.when(F.col("o_orderkey") % 7 > 0, day).alias("start"), F.date_add(day, (F.col("o_orderkey") % 4).cast("int")).alias("end"), F.lit(None).cast("date").alias("actual_start"))
    return metrics.gantt_rows(rows, "path", "o_orderstatus", ("o_orderpriority", "o_orderstatus"), milestones=False).select("o_orderkey", "label", "is_milestone")


@_query("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS approval, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS units, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) END AS spent FROM orders""")
def polymorphic_records(spark, sf):
    """Records whose detail has one shape or another: the columns of the shape that a record lacks are null."""
    status = F.col("o_orderstatus")
    opened = F.when(status == "O", F.struct(F.col("o_orderpriority").alias("approval")))
    closed = F.when(status == "F", F.struct(F.col("o_custkey").alias("units"), F.floor("o_totalprice").alias("spent")))
    raw = _t(spark, sf, "orders").select(F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.struct(opened.alias("open"), closed.alias("closed")).alias("detail"))).alias("raw_data"))
    mappings = [Mapping("id", "id", "long"), Mapping("approval", "detail.open.approval"), Mapping("units", "detail.closed.units", "long"), Mapping("spent", "detail.closed.spent", "double")]
    return variants.map_records(raw, mappings)


# -- pages and child rows


def _pages(spark, sf):
    return _t(spark, sf, "events").groupBy("event_type", "user_id").agg(F.to_json(F.struct(F.collect_list(F.struct("event_id", "value")).alias("items"))).alias("body"))


@_query("SELECT event_type, user_id, event_id FROM events")
def page_records(spark, sf):
    rows = landing.unpack_pages(_pages(spark, sf), "items")
    return rows.select("event_type", "user_id", F.get_json_object("raw_data", "$.event_id").cast("long").alias("event_id"))


@_query("""SELECT c_custkey AS parent_id, count(o_orderkey) AS records, CASE WHEN count(o_orderkey) > 0 THEN 'loaded' ELSE 'skipped' END AS status FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def parent_outcomes(spark, sf):
    records = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return landing.tag_parents(records, _t(spark, sf, "customer").select("c_custkey"), "c_custkey")[1]


def _orders_json(spark, sf):
    """Orders with their lines nested: histories of items, each with labels."""
    item = F.struct(F.col("l_returnflag").alias("field"), F.col("l_partkey").cast("string").alias("fromString"), F.col("l_suppkey").cast("string").alias("toString"))
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linestatus").agg(F.collect_list(item).alias("items"))
    history = F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"), "l_linestatus").alias("id"), F.lit("2024-01-01").alias("created"), F.col("items"))
    nested = lines.groupBy("l_orderkey").agg(F.collect_list(history).alias("histories"))
    return nested.select(F.to_json(F.struct(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("key"), F.struct("histories").alias("changelog"))).alias("raw_data"))


@_query("""SELECT l_orderkey || '-' || l_linestatus AS history_id, 'O' || l_orderkey AS issue_key, l_returnflag AS field_name, CAST(l_partkey AS VARCHAR) AS old_value_formatted, CAST(l_suppkey AS VARCHAR) AS new_value_formatted FROM lineitem""")
def two_level_children(spark, sf):
    """Children of children: the first level keeps its elements' lists, which the second one explodes."""
    first = semi.explode_array(_orders_json(spark, sf), semi.CHILD_TABLES["histories"])
    return semi.explode_array(first, semi.CHILD_TABLES["history_items"]).select("history_id", "issue_key", "field_name", "old_value_formatted", "new_value_formatted")


@_query("SELECT DISTINCT 'C' || o_custkey AS item, o_orderpriority AS label FROM orders")
def scalar_children(spark, sf):
    body = F.struct(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id"), F.collect_set("o_orderpriority").over(metrics.Window.partitionBy("o_custkey")).alias("labels"))
    raw = _t(spark, sf, "orders").select("o_custkey", F.to_json(body).alias("raw_data")).dropDuplicates(["o_custkey"])
    return semi.explode_array(raw, ExplodeSpec("labels", [Mapping("label", "")], "item", "id"))


@_query("""SELECT c_custkey AS id, c_name || ', ' || c_mktsegment AS tags, c_name || ', N' || c_nationkey AS people, c_nationkey AS place_code, '[{"x":' || c_nationkey || '}]' AS sizes FROM customer""")
def array_texts(spark, sf):
    """Lists as one text: strings joined, objects by their name, others as JSON."""
    people = F.array(F.struct(F.col("c_name").alias("displayName")), F.struct(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("displayName")))
    body = F.struct(F.col("c_custkey").alias("id"), F.array("c_name", "c_mktsegment").alias("tags"), people.alias("people"), F.struct(F.col("c_nationkey").alias("code")).alias("place"), F.array(F.struct(F.col("c_nationkey").alias("x"))).alias("sizes"))
    rows = _t(spark, sf, "customer").select(body.alias("b"))
    return semi.auto_standardize(rows.select(F.to_json("b").alias("raw_data")), schema=rows.schema["b"].dataType)


@_query("""SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS kind, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS updated FROM events GROUP BY user_id""")
def standardized(spark, sf):
    """The newest record of each user; columns that no record fills are gone."""
    body = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("updated"), F.lit(None).cast("string").alias("unused"), F.lit("x").alias("self"), F.col("event_id").alias("z"))
    rows = _t(spark, sf, "events").select(body.alias("b"))
    newest = semi.run_auto_standardize(rows.select(F.to_json("b").alias("raw_data")), ["id"], "updated", schema=rows.schema["b"].dataType)
    return newest.select("id", "kind", F.substring("updated", 1, 19).alias("updated"))


@_query("""SELECT p_partkey AS id, p_name AS nick_name, p_brand AS color_2, p_type AS color_3 FROM part""")
def friendly_names(spark, sf):
    """Columns named by ids get the names a lookup table has for them; two with one name get their digits."""
    rows = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("customfield_1"), F.col("p_brand").alias("customfield_2"), F.col("p_type").alias("customfield_3"))
    lookup = _t(spark, sf, "region").where("r_regionkey in (1, 2, 3)").select(F.concat(F.lit("customfield_"), F.col("r_regionkey").cast("string")).alias("id"), F.when(F.col("r_regionkey") == 1, "nick name").otherwise("color").alias("name"))
    return semi.rename_fields(rows, semi.field_names(lookup))


@_query("SELECT event_id, event_type AS plain, CAST(user_id AS VARCHAR) AS tag FROM events")
def unquoted_scalars(spark, sf):
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    return _t(spark, sf, "events").select("event_id", unquoted(quoted(F.col("event_type"))).alias("plain"), unquoted(quoted(F.concat(F.lit("##"), F.col("user_id").cast("string")))).alias("tag"))


# -- calendar span, tree columns, roles


@_query("""WITH e AS (SELECT CAST(max(o_orderdate) AS DATE) + INTERVAL 24 MONTH AS hi, CAST(min(o_orderdate) AS DATE) AS lo FROM orders), d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM e)
SELECT date, CAST(year(date) AS INTEGER) AS year, isodow(date) > 5 AS is_weekend FROM d UNION ALL SELECT DATE '1900-01-01', NULL, NULL""")
def calendar_span(spark, sf):
    """Days from the first order to two years after the last, and the sentinel day."""
    orders = _t(spark, sf, "orders")
    first = str(orders.agg(F.min(F.to_date("o_orderdate"))).first()[0])
    days = calendar.date_dimension(spark, first, calendar.calendar_end(orders, "o_orderdate", first))
    return calendar.add_sentinel_date(days).select("date", "year", "is_weekend")


@_query("SELECT min(least(o_orderdate, l_shipdate)) AS first_start, max(greatest(o_orderdate, l_shipdate)) AS last_end FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def timeline_extent(spark, sf):
    rows = _t(spark, sf, "orders").join(_t(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    return tree.timeline_extent(rows, ["o_orderdate", "l_shipdate"], ["o_orderdate", "l_shipdate"])


@_query(f"SELECT event_id AS id, CASE WHEN event_id > 0 THEN {_sql_guid('(event_id - 1) // 4')} END AS parent_key FROM events")
def parent_keys(spark, sf):
    return add_parent_key(_heap(spark, sf), "parent").select("id", "parent_key")


@_query("""WITH l AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber = 1), i AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT 'Lead' AS role, 1 AS role_sort, count(*) AS pairs FROM l UNION ALL SELECT 'Involved', 2, count(*) FROM i ANTI JOIN l USING (l_suppkey, l_partkey) UNION ALL SELECT 'Reporter', 3, 0""")
def role_counts(spark, sf):
    counts = allocation_roles(spark, sf).groupBy(F.initcap("role").alias("role")).agg(F.count("*").alias("pairs"))
    return recipes.roles(spark).join(counts, "role", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))


# -- roles of one dimension, windows of events, dates before 1582


@_query("""SELECT s.n_name AS buyer_n_name, t.n_name AS seller_n_name, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS pieces FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = c_nationkey JOIN nation t ON t.n_nationkey = s_nationkey GROUP BY ALL""")
def nation_roles(spark, sf):
    """One dimension joined in two roles."""
    lines = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(_t(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    counts = lines.groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("long").alias("pieces"))
    nations = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    buyer, seller = sinks.role_playing(nations, "buyer"), sinks.role_playing(nations, "seller")
    named = counts.join(buyer, F.col("c_nationkey") == F.col("buyer_n_nationkey")).join(seller, F.col("s_nationkey") == F.col("seller_n_nationkey"))
    return named.select("buyer_n_name", "seller_n_name", "lines", "pieces")


@_query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, sf):
    return windowed_counts(_t(spark, sf, "events"), "ts", ["event_type"], "1 hour")


@_query("SELECT o_orderkey, CAST(o_orderdate - INTERVAL 500 YEAR AS DATE) AS old_date FROM orders")
def ancient_orders(spark, sf):
    """Dates before the calendar reform, written and read as they stand."""
    sinks.ancient_dates(spark)
    return Scratch(spark).keep(_t(spark, sf, "orders").select("o_orderkey", F.add_months(F.col("o_orderdate").cast("date"), -6000).alias("old_date")))
