"""More registered queries: test tracker tables, builders of dimensions and facts, guards, report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import add_guid_key
from tidemark.operators import clean, dims, recipes, testing
from tidemark.plans import metrics
from tidemark.plans.queries import _ALLOCATED, _allocations, _query, _sql_guid, _t


@_query("""WITH r AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS status_name, date_trunc('second', ts) AS started_on, CASE WHEN value > 20 THEN date_trunc('second', ts) + INTERVAL 1 HOUR END AS finished_on FROM events)
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY finished_on DESC NULLS LAST, started_on DESC, status_name DESC) = 1""")
def test_runs(spark, sf):
    at = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    done = F.when(F.col("value") > 20, F.date_format(F.col("ts") + F.expr("interval 1 hour"), at))
    body = F.struct(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("status_name"), F.date_format("ts", at).alias("started_on"), done.alias("finished_on"))
    return testing.test_runs(_t(spark, sf, "events").select(F.to_json(body).alias("raw_data")), ["run_id", "status_name", "started_on", "finished_on"])


@_query("""SELECT CAST(c_custkey AS VARCHAR) AS test_set_issue_id, 'S' || c_custkey AS test_set_issue_key, c_name AS test_set_summary, CAST(o_orderkey AS VARCHAR) AS test_issue_id, 'T' || o_orderkey AS test_issue_key
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def test_sets(spark, sf):
    rows = _t(spark, sf, "customer").join(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    text = lambda c: F.col(c).cast("string")
    body = F.struct(text("c_custkey").alias("container_issue_id"), F.concat(F.lit("S"), text("c_custkey")).alias("container_issue_key"), F.col("c_name").alias("container_summary"), text("o_orderkey").alias("test_issue_id"), F.concat(F.lit("T"), text("o_orderkey")).alias("test_issue_key"))
    return testing.containers(rows.select(F.to_json(body).alias("raw_data")), "test_set")


@_query("SELECT DISTINCT event_type AS name, upper(event_type) AS description, CAST(NULL AS VARCHAR) AS color FROM events")
def tracker_statuses(spark, sf):
    body = F.struct(F.col("event_type").alias("name"), F.upper("event_type").alias("description"))
    return testing.statuses(_t(spark, sf, "events").select(F.to_json(body).alias("raw_data")))


@_query("""SELECT p_name AS name, p_type AS category, CASE WHEN p_type = 'PROMO' THEN 'Done' WHEN p_name LIKE '%7%' THEN 'Other' END AS pick, count(*) AS n FROM part GROUP BY ALL""")
def detail_table(spark, sf):
    pick = F.when(F.col("p_type") == "PROMO", "Done").when(F.col("p_name").contains("7"), "Other")
    rows = _t(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("category"), pick.alias("pick"))
    return metrics.detail_table(rows, ["name", "category", "pick"])


@_query("""WITH d AS (SELECT user_id, event_type, value, sum(value) OVER (PARTITION BY user_id) AS t FROM events)
SELECT user_id, event_type, round(sum(value), 4) AS days, count(*) AS periods, round(sum(value) / max(t), 6) AS share FROM d GROUP BY ALL""")
def stage_days(spark, sf):
    out = metrics.stage_days(_t(spark, sf, "events"), "user_id", "event_type", "value")
    return out.withColumns({"days": F.round("days", 4), "share": F.round("share", 6)})


_OFFSETS = [i for i in range(15) if i % 7 < 5]


@_query(f"""WITH {_ALLOCATED}, lo AS (SELECT CAST(date_trunc('week', min(day)) AS DATE) AS d FROM alloc)
SELECT l_suppkey, {", ".join(f"count(DISTINCT l_partkey) FILTER (CAST(day AS DATE) = d + {i}) AS d{i}" for i in _OFFSETS)} FROM alloc, lo WHERE day >= d AND day < d + 15 AND isodow(day) < 6 GROUP BY l_suppkey""")
def day_matrix(spark, sf):
    rows = _allocations(spark, sf)
    first = str(rows.agg(F.trunc(F.min("alloc_date"), "week")).first()[0])
    return metrics.day_matrix(rows, "l_suppkey", "alloc_date", first, 15, F.count_distinct("l_partkey")).toDF("l_suppkey", *[f"d{i}" for i in _OFFSETS])


@_query("""SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'Done' WHEN event_type = 'error' THEN 'Blocked' WHEN event_type = 'signup' THEN 'Not started' ELSE 'In progress' END AS status_group,
CASE WHEN event_type = 'purchase' THEN 'Closed' WHEN event_type = 'signup' THEN 'Waiting' ELSE 'Active' END AS flow_state, event_type = 'purchase' AS is_done, event_type = 'error' AS is_blocked FROM events""")
def status_groups(spark, sf):
    name = F.when(F.col("event_type") == "error", "On hold").otherwise(F.col("event_type"))
    kind = F.when(F.col("event_type") == "purchase", "Done").when(F.col("event_type") == "signup", "To Do").otherwise("Doing")
    rows = _t(spark, sf, "events").select("event_id", name.alias("name"), kind.alias("category"))
    return recipes.status_groups(rows, "name", "category").drop("name", "category")


@_query("""WITH i AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT k AS person, coalesce(c_name, 'Guest ' || k) AS name, CASE WHEN c_name IS NULL THEN false ELSE true END AS active, 8.0::DOUBLE AS daily_capacity FROM i LEFT JOIN customer ON c_custkey = k AND c_nationkey < 12""")
def people(spark, sf):
    directory = _t(spark, sf, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("person"), F.col("c_name").alias("name"), F.lit(True).alias("active"))
    involved = _t(spark, sf, "orders").select(F.col("o_custkey").alias("person"), F.concat(F.lit("Guest "), F.col("o_custkey").cast("string")).alias("name"), F.lit(False).alias("active"))
    return recipes.people(directory, involved, "person", "name")


@_query(f"SELECT p_brand AS team, min(p_partkey) AS member, {_sql_guid('p_brand')} AS team_key FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand")
def named_dimension(spark, sf):
    rows = _t(spark, sf, "part").select(F.col("p_brand").alias("team"), F.col("p_partkey").alias("member"))
    return add_guid_key(recipes.named_dimension(rows, "team", "member"), ["team"], "team_key")


@_query("SELECT n_nationkey AS id, CASE n_name WHEN 'FRANCE' THEN 'France' ELSE n_name END AS label, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL")
def renamed(spark, sf):
    rows = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n"))
    return recipes.renamed(rows, {"n_nationkey": "id", "n_name": "label", "n": "customers"}, {"label": {"FRANCE": "France"}})


@_query("""SELECT DISTINCT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS status, event_type IN ('click', 'purchase') AS is_passed, true AS is_run FROM events UNION ALL SELECT 'Not run', false, false""")
def test_statuses(spark, sf):
    return recipes.test_statuses(_t(spark, sf, "events").select("event_type"), "event_type", ["Click", "purchase"])


@_query("""SELECT event_id AS run_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE WHEN value > 20 THEN ts END DESC NULLS LAST, event_id DESC) = 1 AS is_latest,
CASE WHEN event_type = 'error' THEN false WHEN event_type IN ('click', 'view') THEN true END AS is_passed, value > 20 AS is_finished FROM events""")
def run_fact(spark, sf):
    runs = _t(spark, sf, "events").select(F.col("event_id").alias("run_id"), "user_id", F.col("event_type").alias("status_name"), F.col("ts").alias("started_on"), F.when(F.col("value") > 20, F.col("ts")).alias("finished_on"))
    statuses = spark.createDataFrame([("Click", True), ("View", True), ("Error", False)], "status string, is_passed boolean")
    return recipes.run_fact(runs, "user_id", statuses).select("run_id", F.col("status_name").alias("event_type"), "is_latest", "is_passed", "is_finished")


@_query("""WITH a AS (SELECT DISTINCT l_suppkey AS resource, l_partkey AS item FROM lineitem WHERE l_linenumber = 1)
SELECT l_suppkey AS resource, l_partkey AS item, CASE WHEN a.item IS NULL THEN 'other' ELSE 'lead' END AS role, l_quantity AS hours, count(*) AS n
FROM (SELECT DISTINCT l_suppkey, l_partkey, l_orderkey, l_quantity FROM lineitem) l LEFT JOIN a ON a.resource = l_suppkey AND a.item = l_partkey GROUP BY ALL""")
def worklog_fact(spark, sf):
    lines = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("resource"), F.col("l_partkey").alias("item"), "l_orderkey", (F.col("l_quantity") * 3600).alias("seconds"), "l_linenumber")
    leads = lines.where("l_linenumber = 1").select("resource", "item").distinct().withColumn("role", F.lit("lead"))
    return recipes.worklog_fact(lines.drop("l_linenumber"), leads).groupBy("resource", "item", "role", "hours").agg(F.count("*").alias("n"))


@_query("""WITH w AS (SELECT l_orderkey AS set_id, max(CASE WHEN l_linenumber = 1 THEN l_returnflag END) AS dim_1, max(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS dim_2, max(CASE WHEN l_linenumber = 3 THEN l_returnflag END) AS dim_3, max(CASE WHEN l_linenumber = 4 THEN l_returnflag END) AS dim_4 FROM lineitem GROUP BY ALL)
SELECT o_orderstatus AS account, o_orderkey AS set_id, dim_1, dim_2, dim_3, dim_4, CASE WHEN o_orderstatus = 'F' AND dim_1 = 'R' THEN 'Returns' WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Unknown' END AS mapped FROM orders LEFT JOIN w ON set_id = o_orderkey""")
def account_dimension(spark, sf):
    ledger = _t(spark, sf, "orders").select(F.col("o_orderstatus").alias("account"), F.col("o_orderkey").alias("set_id"))
    places = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("set_id"), F.col("l_linenumber").alias("place"), F.col("l_returnflag").alias("code"))
    mapping = spark.createDataFrame([("F", "R", "Returns"), ("F", None, "Closed")], "account string, dim_1 string, mapped string")
    return recipes.account_dimension(ledger, places, mapping, "account", "set_id")


@_query("""WITH b AS (SELECT DISTINCT l_suppkey, l_partkey, l_returnflag, l_linestatus, l_linenumber, 'B' || l_linenumber AS benefit FROM lineitem WHERE l_linenumber < 3)
SELECT l.l_orderkey, l.l_linenumber, l.l_orderkey // 100 * 100 AS from_entry, coalesce(CASE benefit WHEN 'B1' THEN 'First' ELSE benefit END, 'Unknown') AS benefit FROM lineitem l LEFT JOIN b USING (l_suppkey, l_partkey, l_returnflag, l_linestatus, l_linenumber)""")
def ledger_fact(spark, sf):
    keys = ["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    lines = _t(spark, sf, "lineitem").select("l_orderkey", *keys)
    low = (F.floor(F.col("l_orderkey") / 100) * 100).alias("from_entry")
    registers = lines.select(low).distinct().withColumn("to_entry", F.col("from_entry") + 99)
    benefits = lines.where("l_linenumber < 3").select(*keys, F.concat(F.lit("B"), F.col("l_linenumber").cast("string")).alias("benefit")).distinct()
    entries = lines.withColumn("entry_no", F.col("l_orderkey"))
    return recipes.ledger_fact(entries, registers, benefits, keys, {"B1": "First"}, 100).select("l_orderkey", "l_linenumber", "from_entry", "benefit")


@_query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def dedup_any(spark, sf):
    return clean.dedup_any(_t(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"]).select("l_suppkey", "l_returnflag")


@_query("SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS BIGINT), -1) AS amount, coalesce(CASE WHEN value > 20 THEN event_type END, 'none') AS kind FROM events")
def coerced_defaults(spark, sf):
    rows = _t(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "error", "x").otherwise(F.col("user_id").cast("string")).alias("amount"), F.when(F.col("value") > 20, F.col("event_type")).alias("kind"))
    return clean.with_defaults(rows, {"amount": ("bigint", -1), "kind": ("string", "none")})


@_query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS at FROM events")
def guarded_dates(spark, sf):
    at = F.when(F.col("event_id") % 3 == 0, F.expr("make_date(-5, 1, 1)")).otherwise(F.col("ts").cast("date"))
    return clean.guard_dates(_t(spark, sf, "events").select("event_id", at.alias("at")))


@_query("SELECT user_id, bool_or(value > 100) AS any_large, bool_and(value > 1) AS all_over_one FROM events GROUP BY user_id")
def boolean_flags(spark, sf):
    return _t(spark, sf, "events").groupBy("user_id").agg(F.bool_or(F.col("value") > 100).alias("any_large"), F.bool_and(F.col("value") > 1).alias("all_over_one"))


@_query(f"""WITH d AS (SELECT c_mktsegment AS segment, {_sql_guid('c_mktsegment')} AS segment_key FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1 UNION ALL SELECT 'Unknown', {_sql_guid("'Unknown'")})
SELECT c_custkey, coalesce(d.segment_key, (SELECT segment_key FROM d WHERE segment = 'Unknown')) AS segment_key FROM customer LEFT JOIN d ON c_mktsegment = segment""")
def fallback_keys(spark, sf):
    cust = _t(spark, sf, "customer")
    spec = dims.TableSpec("segment", merge_fields=["segment"], key="segment_key")
    dim = dims.build_table(cust.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("segment")).distinct(), spec)
    fact = dims.lookup_key(cust.select("c_custkey", "c_mktsegment"), dim, "c_mktsegment", "segment", "segment_key")
    return dims.fill_fallbacks(fact, {"segment_key": (dim, "segment", "segment_key")}).select("c_custkey", "segment_key")


@_query("SELECT DISTINCT p_brand AS label, CAST(ascii(substr(p_brand, 7, 1)) AS INTEGER) AS sort_no FROM part ORDER BY sort_no")
def sorted_slicer(spark, sf):
    rows = _t(spark, sf, "part").select(F.col("p_brand").alias("label"), F.ascii(F.substring("p_brand", 7, 1)).alias("sort_no"))
    return metrics.slicer(rows, "label", "sort_no")


@_query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'blocked' ELSE 'active' END AS status_class, o_orderkey % 5 = 0 AS is_milestone, o_orderkey % 2 = 0 AS has_actual FROM orders WHERE o_orderpriority <> '5-LOW'""")
def gantt(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "P", "Blocked").otherwise("In progress")
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    rows = _t(spark, sf, "orders").select("o_orderkey", status.alias("status"), k.cast("string").alias("path"), day.alias("start"), F.when(F.col("o_orderpriority") != "5-LOW", F.when(k % 5 == 0, day).otherwise(F.date_add(day, 3))).alias("end"), F.when(k % 2 == 0, day).alias("actual_start"))
    return metrics.gantt_rows(rows, "path", "status").select("o_orderkey", "status_class", "is_milestone", "has_actual")
