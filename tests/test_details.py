import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, facts, recipes, semi
from tidemark.plans import metrics


def test_first_states(spark):
    log = spark.createDataFrame([(1, "2024-02-02", "b", "a", None, None), (1, "2024-02-01", None, None, 5.0, 3.0), (1, "2024-03-01", "c", "b", 8.0, 5.0), (2, "2024-02-01", "x", None, None, None), (9, "2024-02-01", "x", "y", None, None), (None, None, None, None, None, None)], "k int, at string, s string, s_old string, p double, p_old double").withColumn("at", F.col("at").cast("timestamp"))
    entities = spark.createDataFrame([(1, "c", 8.0), (2, "x", 1.0), (3, "n", None)], "k int, now string, points double").withColumn("made", F.lit("2024-01-01").cast("timestamp"))
    got = facts.first_states(entities, log, "k", "made", "at", {"s": ("s_old", "now"), "p": ("p_old", "points")})
    assert sorted((r["k"], r["s"], r["p"], r["is_seed"]) for r in got.collect()) == [(1, "a", 3.0, True), (2, "x", 1.0, True), (3, "n", None, True)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    both = got.unionByName(log.where("k is not null").select("k", "at", "s", "p", F.lit(False).alias("is_seed")))
    periods = facts.state_periods(both, "k", "at", ["s", "p"], "is_seed").where("k = 1").orderBy("valid_from").collect()
    assert [(r["s"], r["p"], r["is_seed"]) for r in periods] == [("a", 3.0, True), ("a", 5.0, False), ("b", 5.0, False), ("c", 8.0, False)]
    assert facts.first_states(entities.limit(0), log, "k", "made", "at", {"s": ("s_old", "now")}).count() == 0


def test_aged_periods(spark):
    days = calendar.date_dimension(spark, "2024-01-01", "2024-03-31")
    work = calendar.working_calendar(days, days.where("date = '2024-01-03'").select("date"))
    stamp = lambda c: F.col(c).cast("timestamp").alias(c)
    rows = [(1, "2024-01-01", "2024-01-08", "To Do", None, None), (2, "2024-01-01", "2024-01-08", "To Do", "2024-01-05", None), (3, "2024-01-01", "2024-01-08", "Doing", "2024-01-05", None), (4, "2024-01-01", None, "Done", None, "2024-01-02"), (5, "2024-01-01", None, "Done", None, None), (6, "2024-01-01", None, None, None, "2024-01-02"), (7, "2024-01-01", None, "To Do", "2024-02-20", None)]
    periods = spark.createDataFrame(rows, "id int, valid_from string, valid_to string, kind string, planned string, resolved string").select("id", stamp("valid_from"), stamp("valid_to"), "kind", F.col("planned").cast("date").alias("planned"), stamp("resolved"))
    got = facts.aged_periods(periods, F.col("kind") == "To Do", F.col("planned"), F.col("kind") == "Done", F.col("resolved"), "2024-01-10", work)
    have = {r["id"]: (str(r["valid_to"])[:10], r["days_in_period"], r["working_days"]) for r in got.collect()}
    assert have == {1: ("2024-01-08", 7.0, 4), 2: ("2024-01-08", 3.0, 1), 3: ("2024-01-08", 7.0, 4), 4: ("2024-01-02", 1.0, 2), 5: ("2024-01-01", 0.0, 1), 6: ("None", 9.0, 7), 7: ("None", 0.0, 0)}
    assert got.columns == [*periods.columns, "days_in_period", "working_days"]


def test_statuses_of_both_ends(spark):
    runs = spark.createDataFrame([("t1", "PASSED", 1, 5, 1), ("t1", "blocked", 2, None, 2), ("t1", "FAILED", 2, 1, 1), ("t2", "odd", 1, 1, 1), ("t3", "FAILED", None, None, 9), ("t3", "PASSED", 1, None, 1), (None, "PASSED", 9, 9, 9), ("t4", "PASSED", 1, 1, 1), ("t4", "BLOCKED", 1, 1, 2)], "test string, status_name string, started_on int, finished_on int, run_id int")
    assert {r["test"]: r["status_name"] for r in facts.latest_status(runs, "test").collect()} == {"t1": "FAILED", "t2": "odd", "t3": "PASSED", "t4": "BLOCKED"}
    bridge = spark.createDataFrame([("t4", "(none)", False), ("t1", "t4", True), ("t4", "t2", True)], "item string, linked string, has_blocker boolean")
    statuses = recipes.test_status_dimension(spark.createDataFrame([("PASSED", "ok"), ("FAILED", None), ("BLOCKED", "b"), ("BLOCKED", "a"), (None, "z")], "name string, about string"), "name", "about")
    assert {r["status"]: (r["description"], r["coverage"], r["sort_order"], r["is_final"]) for r in statuses.collect()} == {"Passed": ("ok", "Passed", 1, True), "Failed": ("Unknown", "Failed", 2, True), "Blocked": ("a", "Blocked", 3, False), "Not run": ("Test has not been executed yet", "Not run", 6, False)}
    got = facts.with_test_statuses(bridge, runs, statuses, "item", "test").collect()
    assert sorted((r["item"], r["linked"], r["item_status"], r["linked_status"], r["lacks_blocker"]) for r in got) == [("t1", "t4", "Failed", "Blocked", False), ("t4", "(none)", "Blocked", "Unknown", True), ("t4", "t2", "Blocked", "Unknown", False)]
    assert "Window" not in facts.latest_status(runs, "test")._jdf.queryExecution().executedPlan().toString()


def test_declared_schemas_that_say_never_null(spark):
    """A JSON text may lack what its declared schema says is always there."""
    frame = spark.createDataFrame([('{"id": 1, "tags": ["a", null]}',), ("{}",), (None,), ("no json",)], "raw_data string")
    schema = spark.range(1).select(F.lit(1).alias("id"), F.array(F.lit("a")).alias("tags"), F.lit(2).alias("ID")).schema
    for declared in (schema, spark.range(1).select(F.lit(1).alias("id"), F.array(F.lit("a")).alias("tags")).schema):
        rows = semi.auto_standardize(frame, schema=declared).collect()
        assert [(r["id"], r["tags"]) for r in rows] == [(1, "a"), (None, None), (None, None), (None, None)]


@pytest.mark.parametrize("wanted, ids", [(None, [1, 2]), (True, [2]), (False, [1])])
def test_gantt_labels_and_milestones(spark, wanted, ids):
    rows = spark.createDataFrame([(1, "a", "A", "one", 1, 2), (2, "b", None, "two", 3, 3), (3, "c", "C", "x", None, 3)], "id int, path string, code string, summary string, start int, end int").withColumns({"status": F.lit("Done"), "actual_start": F.lit(None).cast("int")})
    got = metrics.gantt_rows(rows, "path", "status", ("code", "summary"), wanted).collect()
    assert [r["id"] for r in got] == ids and {r["label"] for r in got} <= {"A: one", "two"}


def test_rich_text_of_any_shape(spark):
    import json

    from tidemark.functions.documents import rich_text, rich_text_flat

    text = lambda t: {"type": "text", "text": t}
    item = {"type": "listItem", "content": [{"type": "paragraph", "content": [text("a"), {"type": "hardBreak"}, {"type": "mention", "attrs": {"text": "bo"}}]}]}
    cases = {
        json.dumps({"type": "doc", "content": [{"type": "bulletList", "content": [item, item]}, {"type": "rule"}, {"type": "paragraph", "content": [text(" é "), {"type": "emoji", "attrs": {"text": ":)"}}, {"type": "hardBreak"}]}]}): "a\n@boa\n@bo\n\né :)",
        json.dumps([{"type": "paragraph", "content": [[text("x")], {"type": "mention"}, {"type": "text"}, 7, None]}]): "x@",
        '"said"': "said", "5": "5", "0": None, "false": None, "true": "True", "null": None, '""': None, "{}": None, "[]": None, "no json": "no json", "": "",
    }
    frame = spark.createDataFrame([(k,) for k in [*cases, None]], "d string")
    got = {r[0]: r[1] for r in frame.select("d", rich_text(F.col("d"))).collect()}
    assert got == {**cases, None: None}
    assert "Python" not in frame.select(rich_text(F.col("d")))._jdf.queryExecution().executedPlan().toString()
    assert spark.createDataFrame([(json.dumps([{"type": "p", "content": [{"type": "hardBreak"}, text("x")]}]),)], "d string").select(rich_text_flat(F.col("d"))).first()[0] == "x"
    deep = text("low")
    for _ in range(14):
        deep = {"type": "listItem", "content": [deep]}
    frame = spark.createDataFrame([(json.dumps([deep]),)], "d string")
    with pytest.raises(Exception, match="nested too deeply"):
        frame.select(rich_text(F.col("d"))).collect()
    assert frame.select(rich_text(F.col("d"), depth=20)).first()[0] == "low"
