import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions.documents import at_path, rich_text, rich_text_flat, typed
from tidemark.functions.keys import NAMESPACE, add_guid_key, guid
from tidemark.operators import calendar, clean, dims, facts, history, intervals, recipes, semi, testing, tree
from tidemark.plans import metrics, spec
from tidemark.sources import landing, runlog, sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_guid_is_uuid5(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("é||", None)], "a string, b long")
    got = {r["k"] for r in add_guid_key(df, ["a", "b"], "k").collect()}
    assert got == {str(uuid.uuid5(uuid.UUID(NAMESPACE), n)) for n in ("a||1", "||2", "é||||")}
    with pytest.raises(ValueError):
        add_guid_key(df, ["a"], "A")


def test_paths_and_types(spark):
    df = spark.createDataFrame([('{"a":{"b":"7"},"x.y":1,"l":[1],"d":"2024-02-30"}',), ("oops",), (None,)], "j string")
    got = df.select(typed(at_path(F.col("j"), "a.b"), "long"), at_path(F.col("j"), "l"), typed(at_path(F.col("j"), "d"), "date"), at_path(F.col("j"), "q", "-")).collect()
    assert tuple(got[0]) == (7, "[1]", None, "-") and tuple(got[1]) == (None, None, None, "-")
    with pytest.raises(ValueError):
        typed(F.lit("1"), "money")


def test_rich_text(spark):
    doc = '{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":"a"},{"type":"hardBreak"},{"type":"mention","attrs":{"text":"bo"}}]},{"type":"paragraph","content":[]},{"type":"paragraph","content":[{"type":"emoji","attrs":{"text":":)"}}]}]}'
    nested = '[{"type":"bulletList","content":[{"type":"listItem","content":[{"type":"paragraph","content":[{"type":"text","text":"x"}]}]}]}]'
    df = spark.createDataFrame([(doc,), (nested,), ("plain",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(rich_text("d")).collect()] == ["a\n@bo\n\n:)", "x", "plain", "", None]
    assert df.select(rich_text_flat(F.col("d"))).first()[0] == "a\n@bo\n\n:)"


def test_flatten_and_rename(spark):
    df = spark.createDataFrame([('{"id":1,"a b":{"c":2},"a_b":{"c":3},"v":[{"value":"x"},{"value":"y"}],"n":[{"displayName":"q"}],"s":["1","2"],"o":[{"z":1}]}',)], "raw_data string")
    got = semi.auto_standardize(df).first().asDict()
    assert got["v"] == "x, y" and got["n"] == "q" and got["s"] == "1, 2" and got["o"] == '[{"z":1}]' and {got["a_b_c"], got["a_b_c_2"]} == {2, 3}
    named = semi.rename_fields(spark.createDataFrame([(1, 2, 3)], "customfield_1 int, customfield_2_x int, other int"), {"customfield_1": "Story Points", "customfield_2": "Team"})
    assert named.columns == ["Story_Points", "Team_x", "other"]
    twice = semi.rename_fields(spark.createDataFrame([(1, 2)], "customfield_1 int, customfield_2 int"), {"customfield_1": "A", "customfield_2": "A"})
    assert twice.columns == ["A_1", "A_2"]
    assert semi.clean_rich_text_columns(spark.createDataFrame([("[]", "doc", 1)], "b_content string, b_type string, b_version int")).columns == ["b"]


def test_explode_two_levels(spark):
    df = spark.createDataFrame([('{"key":"K","changelog":{"histories":[{"id":"1","items":[{"field":"status","toString":"Done"}]},{"id":"2","items":[]}]},"fields":{"labels":["x","y"]}}',), ('{"key":"E","fields":{"labels":7}}',), ("bad",)], "raw_data string")
    made = semi.explode_array(df, semi.CHILD_TABLES["histories"])
    assert [r["history_id"] for r in made.collect()] == ["1", "2"]
    assert [r["new_value_formatted"] for r in semi.explode_array(made, semi.CHILD_TABLES["history_items"]).collect()] == ["Done"]
    assert [r["label"] for r in semi.explode_array(df, semi.CHILD_TABLES["issue_labels"]).collect()] == ["x", "y"]
    assert len(semi.CHILD_TABLES) == 19


def test_clean(spark):
    df = spark.createDataFrame([(1, "a", " ", None, None), (2, None, "", None, None)], "id int, t string, blank string, none int, _kept int")
    assert clean.drop_empty_columns(df).columns == ["id", "t", "_kept"]
    assert clean.drop_empty_columns(df.limit(0)).columns == df.columns
    far = spark.sql("select date'+12000-01-01' d, date'2020-01-01' e")
    assert clean.guard_dates(far).select(F.col("d").isNull(), F.col("e").isNull()).first()[:] == (True, False)
    with pytest.raises(ValueError):
        clean.assert_unique(spark.range(2).withColumn("k", F.lit(1)), ["k"])
    with pytest.raises(ValueError, match="null"):
        clean.assert_keys(df, ["t"])
    with pytest.raises(ValueError, match="missing"):
        clean.assert_columns(df, {"id": "int", "zz": "int"})
    assert clean.with_defaults(spark.createDataFrame([("x",), ("3",)], "n string"), {"n": ("int", -1)}).collect()[0][0] == -1


def test_build_table_and_lookups(spark):
    dim = dims.build_table(spark.createDataFrame([("a", 1), ("b", 2)], "code string, n int"), dims.TableSpec("d", merge_fields=["code"], key="k"))
    assert dim.count() == 3 and dims.add_unknown_member(dim, {"code": "Unknown"}).count() == 3
    fact = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, c string")
    got = {r["id"]: r["k"] for r in dims.lookup_key(fact, dim, "c", "code", "k", default_to_unknown=True).collect()}
    unknown = dims.unknown_key(dim, "code", "k")
    assert got[2] == got[3] == unknown != got[1]
    with pytest.raises(ValueError):
        dims.TableSpec("f", "fact", ["a"], unknown_member=True)
    with pytest.raises(ValueError, match="repeated"):
        dims.build_table(spark.createDataFrame([("a",), ("a",)], "code string"), dims.TableSpec("d", merge_fields=["code"], key="k"))
    filled = dims.fill_fallbacks(fact.withColumn("k", F.lit(None).cast("string")), {"k": (dim, "code", "k")})
    assert {r["k"] for r in filled.collect()} == {unknown}


def test_upsert_and_history(spark):
    old = spark.createDataFrame([(1, None, "x"), (2, "p", "y")], "a int, b string, v string")
    new = spark.createDataFrame([(1, None, "z", 5)], "a int, b string, v string, w int")
    once = history.upsert(old, new, ["a", "b"])
    assert rows(once) == rows(history.upsert(once, new, ["a", "b"])) == [(1, None, "z", 5), (2, "p", "y", None)]
    assert "<=>" in history.merge_sql("t", "s", ["a"], ["a", "b"])
    snap = lambda *r: spark.createDataFrame(list(r), "id int, p string, q string")
    h = history.scd2_merge(None, snap((1, "A", None), (2, "x", "y")), ["id"], ["p", "q"], "2024-01-01")
    h = history.scd2_merge(h, snap((1, None, "A"), (3, "n", "n")), ["id"], ["p", "q"], "2024-02-01")
    h = history.scd2_merge(h, snap((1, "A", None)), ["id"], ["p", "q"], "2024-03-01")
    ones = h.where("id = 1").orderBy("valid_from").collect()
    assert [r["is_current"] for r in ones] == [False, False, True] and ones[0]["key"] != ones[2]["key"]
    assert [r["valid_to"] for r in ones[:2]] == [r["valid_from"] for r in ones[1:]]
    assert h.where("id = 2 and is_current").count() == 1 and h.count() == 5


def test_calendar(spark):
    def sunday(y):
        a, b, c = y % 19, y // 100, y % 100
        h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
        k = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
        s = h + k - 7 * ((a + 11 * h + 22 * k) // 451) + 114
        return dt.date(y, s // 31, s % 31 + 1)

    got = {r[0]: r[1] for r in spark.range(1900, 2200).select(F.col("id").cast("int").alias("y"), calendar.easter(F.col("id").cast("int"))).collect()}
    assert all(got[y] == sunday(y) for y in got)
    off = {r[0] for r in calendar.holidays(spark, 2021, 2022, "jersey").collect()}
    assert {dt.date(2021, 12, 27), dt.date(2021, 12, 28), dt.date(2022, 1, 3), dt.date(2022, 12, 26), dt.date(2022, 12, 27), dt.date(2022, 5, 9)} <= off
    days = calendar.date_dimension(spark, "2024-02-28", "2024-03-02", 4)
    assert days.count() == 4 and days.where("date = '2024-02-29'").first()["fiscal_year"] == 2024
    twice = calendar.add_sentinel_date(calendar.add_sentinel_date(days))
    assert twice.count() == 5
    assert calendar.calendar_end(spark.createDataFrame([("2025-05-05",)], "d string"), "d", "2024-01-01") == "2027-05-05"


def test_working_days_match_a_range_join(spark):
    days = calendar.working_calendar(calendar.date_dimension(spark, "2024-01-01", "2024-12-31"), calendar.holidays(spark, 2024, 2024))
    spans = spark.createDataFrame([(i, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", 3 * i) for i in range(60)] + [(99, "2023-12-20", 400)], "id int, s string, n int").withColumn("a", F.to_date("s")).withColumn("b", F.date_add("a", F.col("n")))
    got = {r["id"]: r["working_days"] for r in calendar.add_working_days(spans, "a", "b", days).collect()}
    want = {r["id"]: r["n"] for r in spans.join(days.where("is_working_day"), (F.col("date") >= F.col("a")) & (F.col("date") < F.col("b")), "left").groupBy("id").agg(F.count("date").alias("n")).collect()}
    assert got == want


TREE = [("r", None, "R", "1", 0, None, None), ("a", "r", "A", "2", 1, None, None), ("b", "a", "B", None, 1, None, None), ("c", "b", "C", "3", 2, "2024-01-05", "2024-01-09"), ("d", "a", "D", "3", 2, "2024-01-02", None), ("o", "gone", "O", "9", 2, None, None)]


def _tree(spark):
    return spark.createDataFrame(TREE, "id string, parent string, code string, rank string, kind int, s string, e string").withColumns({"s": F.to_date("s"), "e": F.to_date("e")})


def test_trees(spark):
    df = _tree(spark)
    dense = {r["id"]: [r[f"level_{i}"] for i in range(1, 5)] for r in tree.dense_levels(df, "id", "parent", "code", 4).collect()}
    assert dense["c"] == ["R", "A", "B", "C"] and dense["o"] == ["O", None, None, None]
    typed_ = {r["id"]: (r["level_1"], r["level_2"], r["level_3"]) for r in tree.typed_levels(df, "id", "parent", "code", "kind", {0: 1, 1: 2, 2: 3}).collect()}
    assert typed_["c"] == ("R", "B", "C") and typed_["b"] == ("R", "B", None)
    paths = tree.sort_paths(df, "id", "parent", "rank")
    assert {r["id"]: (r["sort_path"], r["depth"]) for r in paths.collect()}["c"] == ("1!2!b!3", 3)
    cols = ["id", "rolled_start", "rolled_end", "has_own_dates"]
    walk = rows(tree.rollup_dates(df, "id", "parent", "s", "e").select(cols))
    assert walk == rows(tree.rollup_dates_by_path(paths, "sort_path", "s", "e").select(cols))
    assert dict((r[0], r[1]) for r in walk)["r"] == dt.date(2024, 1, 2)
    full = tree.enrich(df.drop("s", "e"), "id", "parent", "code", "rank", "kind", {0: 1, 1: 2, 2: 3}, {1: "programme"}, 5)
    assert "programme" in full.columns and "rank" not in full.columns
    with pytest.raises(ValueError, match="deeper"):
        tree.dense_levels(df, "id", "parent", "code", 2)
    loop = spark.createDataFrame([("a", "b", "A"), ("b", "a", "B")], "id string, parent string, code string")
    with pytest.raises(ValueError, match="cycle"):
        tree.dense_levels(loop, "id", "parent", "code")
    with pytest.raises(ValueError, match="without a level"):
        tree.typed_levels(df, "id", "parent", "code", "kind", {0: 1, 1: 2})


def test_tree_rebuild(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a!b!c"), (3, "a!d"), (4, None)], "id int, path string")
    got = {r["id"]: (r["parent_path"], r["depth"], r["first_child"]) for r in tree.rebuild_tree(df, "id", "path").collect()}
    assert got == {1: (None, 0, False), 2: ("a", 1, True), 3: ("a", 1, False), 4: (None, None, False)}


def test_intervals(spark):
    spans = spark.createDataFrame([(0, 9, "a"), (10, 25, "b"), (40, 41, "c")], "lo int, hi int, n string")
    got = {r["x"]: r["n"] for r in intervals.join_points(spark.range(45).withColumnRenamed("id", "x"), spans, "x", "lo", "hi", 7).collect()}
    assert got[9] == "a" and got[10] == got[25] == "b" and got[30] is None and got[41] == "c"
    intervals.assert_disjoint(spans, "lo", "hi")
    with pytest.raises(ValueError):
        intervals.assert_disjoint(spans.union(spark.createDataFrame([(5, 6, "z")])), "lo", "hi")


def test_facts(spark):
    log = spark.createDataFrame([(1, "2024-01-01", "new", 1.0), (1, "2024-01-02", None, 3.0), (1, "2024-01-02", "done", None), (1, "2024-01-05", "new", None)], "id int, at string, state string, points double").withColumn("at", F.to_timestamp("at"))
    p = facts.state_periods(log, "id", "at", ["state", "points"])
    assert [(r["state"], r["points"]) for r in p.orderBy("valid_from").collect()] == [("new", 1.0), ("done", 3.0), ("new", 3.0)]
    assert [r["is_reopen"] for r in facts.flag_reopened(p, "id", F.col("state") == "done").orderBy("valid_from").collect()] == [False, False, True]
    alloc = spark.createDataFrame([("p", "i", "lead", 1, "2024-01-05", "2024-01-08", 8.0), ("p", "i", "involved", 0, "2024-01-05", "2024-01-08", 8.0), ("q", "i", "lead", 1, "2024-01-06", "2024-01-07", 8.0)], "r string, i string, role string, w int, a string, b string, h double").withColumns({"a": F.to_date("a"), "b": F.to_date("b")})
    got = facts.day_allocations(alloc, "r", "i", "role", "w", "a", "b", "h").collect()
    assert [(x["r"], x["allocated_hours"]) for x in got] == [("p", 4.0), ("p", 4.0)]
    assert metrics.overallocated(alloc.withColumn("cap", F.lit(0)), "r", "w", "cap").count() == 2


def test_recipes(spark):
    bands = recipes.keyword_bands(spark.createDataFrame([("Highest",), ("p2 - x",), ("lowest",), (None,)], "n string"), "n").collect()
    assert [(b["sort_order"], b["band"]) for b in bands] == [(1, "Critical"), (2, "High"), (5, "Low"), (9, "Unknown")]
    words = recipes.vocabulary(spark, {"Todo": ["Open"], "Doing": ["open", "Active"]})
    df = spark.createDataFrame([(" OPEN ",), ("weird",)], "s string")
    assert [r["stage"] for r in recipes.map_vocabulary(df, "s", words, F.lit("?")).collect()] == ["Todo", "?"]
    assert recipes.unmapped(df, "s", words).count() == 1
    who = recipes.people(spark.createDataFrame([("1", "A", True)], "p string, n string, active boolean"), spark.createDataFrame([("1", "A", True), ("2", "B", True), ("2", "B2", False)], "p string, n string, active boolean"), "p", "n")
    assert sorted(r["n"] for r in who.collect()) == ["A", "B2"]
    assert recipes.test_statuses(spark.createDataFrame([("PASSED",), ("failed",)], "s string"), "s", ["passed"]).count() == 3
    done = recipes.status_groups(spark.createDataFrame([("Closed", "Done"), ("On hold", "In Progress")], "n string, c string"), "n", "c").collect()
    assert [d["status_group"] for d in done] == ["Done", "Blocked"]
    items = spark.createDataFrame([("1", "a", "2024-01-01", "2024-01-05", None, None, "2024-01-01", None, 7200), ("2", "a!b", "2024-01-03", "2024-01-09", None, None, "2024-01-01", None, 0)], "id string, path string, start string, end string, actual_start string, actual_end string, created string, resolved string, estimate_seconds int")
    items = items.withColumns({c: F.to_date(c) for c in ("start", "end", "actual_start", "actual_end", "created", "resolved")})
    changes = spark.createDataFrame([("1", "2024-01-02", "Active"), ("1", "2024-01-03", "Approved")], "id string, at string, status string").withColumn("at", F.to_timestamp("at"))
    links = spark.createDataFrame([("1", "9", "Test"), ("1", "9", "Test")], "id string, linked string, linked_type string")
    got = {r["id"]: r for r in recipes.schedule_fact(items, changes, links, "2024-01-07", ["Active"]).collect()}
    assert got["1"]["tests"] == 1 and got["1"]["lead_days"] == 2 and got["1"]["is_overdue"] and not got["2"]["is_overdue"] and got["1"]["estimate_hours"] == 2.0
    entries = spark.createDataFrame([(5, "A"), (50, "B")], "entry_no int, acc string")
    regs = spark.createDataFrame([(1, 1, 9)], "register_no int, from_entry int, to_entry int")
    ben = spark.createDataFrame([("A", "X")], "acc string, benefit string")
    assert {(r["entry_no"], r["register_no"], r["benefit"]) for r in recipes.ledger_fact(entries, regs, ben, ["acc"], {"X": "Y"}).collect()} == {(5, 1, "Y"), (50, None, "Unknown")}


def test_landing(spark, tmp_path):
    path = str(tmp_path / "land")
    recs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    env = landing.envelope(recs, "s", "e", "l1", "id", "2024-01-02 03:04:05")
    assert landing.land(env, path) == 2 and landing.land(env.limit(0), path) == 0
    assert landing.read_landed(spark, path, since="2024-01-02", load_id="l1").count() == 2 and landing.read_landed(spark, path, since="2024-01-03").count() == 0
    pages = spark.createDataFrame([("e", 1, '{"items":[{"id":1},{"id":2}],"total":3}'), ("e", 2, '{"items":[{"id":3}],"total":3}'), ("f", 1, '{"total":3}')], "entity string, page_no int, body string")
    assert landing.unpack_pages(pages, "items").count() == 3
    assert {r["entity"]: r["is_complete"] for r in landing.check_pages(pages, 2, total_path="total", records_path="items").collect()} == {"e": True, "f": False}
    raw = spark.createDataFrame([('{"u":"2024-05-06T07:08:09.000+0000"}',), ('{"u":"2024-01-01T00:00:00"}',)], "raw_data string")
    assert landing.new_watermark(raw, "u", "x").first()[0] == "2024-05-06 07:08" and landing.new_watermark(raw.limit(0), "u", "x").first()[0] == "x"
    control = landing.save_watermark(None, "e", "1", "2024-01-01", spark)
    control = landing.save_watermark(control, "e", "2", "2024-01-02", spark)
    assert landing.get_watermark(control, "e", "0") == "2" and landing.get_watermark(control, "q", "0") == "0" and control.count() == 1
    tagged, outcome = landing.tag_parents(recs, spark.createDataFrame([(1,), (7,)], "id int"), "id")
    assert {r["parent_id"]: r["status"] for r in outcome.collect()} == {1: "loaded", 7: "skipped"}


def test_folders(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(1, " ")], "`a b` int, c string").write.parquet(f"{src}/t1")
    (tmp_path / "src" / "t2").mkdir()
    (tmp_path / "src" / "bad").mkdir()
    (tmp_path / "src" / "bad" / "x.parquet").write_text("no")
    spark.range(1).write.parquet(f"{out}/old")
    got = {r.name: r.status for r in sinks.clean_folder(spark, src, out)}
    assert got == {"t1": "written", "t2": "empty", "bad": "failed", "old": "pruned"}
    assert spark.read.parquet(f"{out}/t1").columns == ["a_b"]
    sinks.upsert_table(spark.createDataFrame([(1, "x")], "a_b int, v string"), f"{out}/t1", ["a_b"])
    assert rows(spark.read.parquet(f"{out}/t1")) == [(1, "x")]
    assert sinks.retire_columns(spark, f"{out}/t1", ["v", "zz"]) and not sinks.retire_columns(spark, f"{out}/t1", ["v"])
    assert sinks.read_optional(spark, f"{out}/none", "a int").count() == 0
    assert sinks.model_view(spark.createDataFrame([("ab cd", 1)], "my_name string, x int"), ("x",), ("my_name",)).collect()[0]["my name"] == "Ab Cd"
    assert sinks.run_all({"a": lambda: 1, "b": lambda: 1 / 0})["b"].startswith("failed")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.log_step(spark, path, "r1", "a", "failed", "2024-01-01 00:00:00")
    runlog.log_step(spark, path, "r1", "a", "succeeded", "2024-01-01 00:01:00")
    log = spark.read.parquet(path)
    assert runlog.completed_steps(log, "r1") == {"a"} and runlog.completed_steps(None, "r1") == set()
    assert runlog.resolve_run_id(log, ["a", "b"]) == "r1" and runlog.resolve_run_id(log, ["a"]) != "r1" and runlog.resolve_run_id(log, ["a"], "o") == "o"


def test_specs_and_streams(spark, tmp_path):
    with pytest.raises(ValueError):
        spec.load_gold([{"table_name": "x", "select_sql": "", "oops": 1}])
    spark.createDataFrame([("a",)], "c string").createOrReplaceTempView("src_rows")
    built = spec.build_gold(spark, spec.load_gold([{"table_name": "dim_c", "select_sql": "select c from src_rows", "merge_fields": ["c"], "key": "ck"}]))
    assert built["dim_c"].count() == 2
    assert spec.load_source({"source_name": "s", "entities": [{"entity_name": "e"}]}).entities[0].page_size == 100
    from tidemark.streaming import landing as stream

    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(str(tmp_path / "in"))
    s = stream.stream_envelopes(spark, str(tmp_path / "in"), "id int, v string", "s", "e", "id")
    stream.land_stream(s, str(tmp_path / "land"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "land")).count() == 2
    live = spark.readStream.schema("id int, v string").parquet(str(tmp_path / "in"))
    stream.upsert_stream(live, str(tmp_path / "tab"), ["id"], "v", str(tmp_path / "cp2")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "tab")).count() == 2
    _ = guid


def test_a_key_twice_is_an_error(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    one = rows.where("v <> 'b'")
    for call in (lambda: history.upsert(None, rows, ["k"]), lambda: history.scd2_merge(None, rows, ["k"], ["v"], "2020-01-01")):
        with pytest.raises(ValueError, match="repeated keys"):
            call()
    first = history.scd2_merge(None, one, ["k"], ["v"], "2020-01-01")
    with pytest.raises(ValueError, match="repeated keys"):
        history.scd2_counts(first, rows, ["k"], ["v"])
    assert history.scd2_counts(first, one, ["k"], ["v"]).first().asDict() == {"inserted": 0, "changed": 0, "unchanged": 2}


def test_a_broken_swap_loses_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    os.rename(path, f"{path}__before")  # as if it broke off between the two moves
    sinks.upsert_table(spark.createDataFrame([(2, "c")], "k int, v string"), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c")]
    assert not os.path.exists(f"{path}__before")


def test_built_tables_are_written_by_their_kind(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "id string, v string")
    dim, path = dims.TableSpec("d", merge_fields=["id"]), str(tmp_path / "d")
    spec.merge_table(rows(("a", "1"), ("b", "1")), dim, path)
    got = spec.merge_table(rows(("b", "2"), ("c", "2")), dim, path)
    assert sorted((r.id, r.v) for r in got.collect() if r.id != "Unknown") == [("a", "1"), ("b", "2"), ("c", "2")]
    assert got.where("id = 'Unknown'").count() == 1 and got.select("key").distinct().count() == 4
    whole = dims.TableSpec("d", merge_fields=["id"], write_mode="overwrite")
    assert {r.id for r in spec.merge_table(rows(("z", "9")), whole, path).collect()} == {"z", "Unknown"}
    hist, path = dims.TableSpec("h", "scd2", ["id"], tracked=["v"], unknown_member=False), str(tmp_path / "h")
    spec.merge_table(rows(("a", "1"), ("b", "1")), hist, path, "2024-01-01")
    got = spec.merge_table(rows(("a", "2"), ("b", "1")), hist, path, "2024-02-01")
    assert sorted((r.id, r.v, r.is_current) for r in got.collect()) == [("a", "1", False), ("a", "2", True), ("b", "1", True)]


def test_configured_tables_are_written_in_order(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int").createOrReplaceTempView("raw_items")
    tables = spec.load_gold([{"table_name": "first_t", "select_sql": "SELECT id FROM raw_items", "merge_fields": ["id"]}, {"table_name": "second_t", "kind": "fact", "select_sql": "SELECT r.id, f.key AS first_key FROM raw_items r JOIN first_t f USING (id)", "merge_fields": ["id"], "key": "k"}])
    spec.build_gold(spark, tables, str(tmp_path))
    spec.build_gold(spark, tables, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "first_t")).count() == 3
    assert {r.id for r in spark.read.parquet(str(tmp_path / "second_t")).collect()} == {"a", "b"}


def test_test_tracker_tables(spark):
    land = lambda *r: spark.createDataFrame([(x,) for x in r], "raw_data string")
    cols = ["run_id", "status_name", "started_on", "finished_on"]
    first = testing.test_runs(land('{"run_id":"1","status_name":"TODO","started_on":"2026-01-01T00:00:00Z","finished_on":""}', '{"run_id":"1","status_name":"PASS","finished_on":"2026-01-02T00:00:00Z"}', '{"status_name":"x"}', "broken", None), cols)
    assert [(r.run_id, r.status_name) for r in first.collect()] == [("1", "PASS")]
    again = testing.test_runs(land('{"run_id":"1","status_name":"FAIL"}', '{"run_id":"2"}'), cols, first)
    assert sorted((r.run_id, r.status_name) for r in again.collect()) == [("1", "FAIL"), ("2", None)]
    c = testing.containers(land('{"container_issue_id":"7"}', '{"container_issue_id":"7"}', '{"container_issue_id":"8","test_issue_id":"t"}', "{}"), "test_plan")
    assert sorted((r.test_plan_issue_id, r.test_issue_id) for r in c.collect()) == [("7", None), ("8", "t")]
    assert testing.containers(land('{"container_issue_id":"7"}'), "test_plan", c).count() == 2
    assert testing.tests(land('{"test_issue_id":"t","steps_json":"[1]"}', '{"test_issue_id":"t","steps_json":"[1]"}', "{}")).count() == 1
    assert testing.test_runs(land(), cols).count() == 0


def test_payload_names_that_differ_in_case_only(spark):
    rows = spark.createDataFrame([('{"Ab":1,"ab":2,"s":{"K":"x","k":"y"},"l":[{"V":1}]}',), (None,), ('{"Ab":3}',)], "raw_data string")
    got = semi.auto_standardize(rows)
    assert got.columns == ["Ab", "ab_2", "l", "s_K", "s_k_2"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, 2, '[{"V":1}]', "x", "y"), (3, None, None, None, None), (None,) * 5]))


def test_landing_bounds_the_rows_of_a_file(spark, tmp_path):
    env = landing.envelope(spark.range(10, numPartitions=1).select("id"), "app", "thing", "l", "id", "2026-01-01")
    assert landing.land(env, str(tmp_path / "x"), 4) == 10
    files = [f for _, _, names in os.walk(tmp_path / "x") for f in names if f.endswith(".parquet")]
    assert len(files) == 3 and landing.read_landed(spark, str(tmp_path / "x")).count() == 10


def test_weekdays_are_counted_without_a_second_window(spark):
    alloc = spark.createDataFrame([(1, 1, "lead", 1, dt.date(2026, 1, 1), dt.date(2026, 1, 6), 8.0), (1, 2, "lead", 1, dt.date(2026, 1, 3), dt.date(2026, 1, 4), 8.0)], "r int, i int, role string, w int, a date, b date, h double")
    days = facts.day_allocations(alloc, "r", "i", "role", "w", "a", "b", "h")
    assert sorted((r.i, r.alloc_date.day, r.allocated_hours) for r in days.collect()) == [(1, 1, 2.0), (1, 2, 2.0), (1, 5, 2.0), (1, 6, 2.0)]
    assert "_days" not in days.columns and days._jdf.queryExecution().toString().count("+- Window [count") == 0
