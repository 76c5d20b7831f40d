"""Bucketed tables, guards in the write, ranked keys, parsed records, schema sketches, ranges, scans, sweeps, deep trees."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import bitmaps, calendar, deep_tree, dims, facts, intervals, ranked, scans, schema_sketch, semi, sweep, variants
from tidemark.plans import spec
from tidemark.plans.queries import QUERIES
from tidemark.sources.buckets import BucketTable, Guards, wider
from tidemark.sources.sinks import fair_settings, run_fairly
from tidemark.streaming.landing import upsert_bucket_stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    out = BucketTable(spark, str(tmp_path / "t"), ["k"], 8)
    out.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    return out


def test_upsert_leaves_untouched_files_alone(spark, table):
    before = table.manifest()["files"]
    names = {b: sorted(os.listdir(f"{table.path}/{f}")) for b, f in before.items()}
    assert table.upsert(spark.createDataFrame([(5, "b", 1), (1000, "c", 2)], "k int, v string, w int")) == 2
    after = table.manifest()["files"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2
    assert all(sorted(os.listdir(f"{table.path}/{before[b]}")) == names[b] for b in before)
    got = {r["k"]: (r["v"], r["w"]) for r in table.read().collect()}
    assert len(got) == 101 and got[5] == ("b", 1) and got[1000] == ("c", 2) and got[7] == ("a", None)
    assert table.read(1).count() == 100 and table.read(1).columns == ["k", "v"]
    # the same again: nothing differs
    table.upsert(spark.createDataFrame([(5, "b", 1), (1000, "c", 2)], "k int, v string, w int"))
    assert {r["k"]: (r["v"], r["w"]) for r in table.read().collect()} == got
    assert table.upsert(table.read().limit(0)) == 3


def test_upsert_has_one_exchange_and_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    t = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    source = spark.range(50).select(counted("id").alias("k"), F.lit(1).alias("v"))
    t.upsert(source, Guards(no_null_keys=True, types={"k": "bigint", "v": "int"}))
    assert seen.value == 50
    t.upsert(source, Guards(no_null_keys=True))
    assert seen.value == 100
    dealt = t._bucketed(spark.range(9).withColumnRenamed("id", "k"), T.StructType([T.StructField("k", T.LongType())]))
    plan = t._merged(dealt.withColumn("__new", F.lit(1)), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_guards_publish_nothing(spark, table):
    before, folders = table.read().count(), len(os.listdir(f"{table.path}/data"))
    twice = spark.createDataFrame([(5, "b"), (5, "c")], "k long, v string")
    with pytest.raises(ValueError, match="repeated keys, 1, .*5"):
        table.upsert(twice)
    with pytest.raises(ValueError, match="null keys, 1"):
        table.upsert(spark.createDataFrame([(None, "b"), (6, "c")], "k long, v string"), Guards(no_null_keys=True))
    with pytest.raises(ValueError, match="v: int for string.*w: missing"):
        table.upsert(spark.range(1).select(F.col("id").alias("k"), F.lit(1).alias("v")), Guards(types={"v": "string", "w": "int"}))
    with pytest.raises(ValueError, match="keys missing"):
        table.upsert(spark.range(1))
    with pytest.raises(ValueError, match="reserved"):
        table.upsert(spark.range(1).select(F.col("id").alias("k"), F.lit(1).alias("__NEW")))
    with pytest.raises(TypeError):
        table.upsert(spark.createDataFrame([(1, 2)], "k long, v int"))
    assert table.versions() == [1] and table.read().count() == before and len(os.listdir(f"{table.path}/data")) == folders


def test_null_keys_are_equal_and_columns_widen(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), ["a", "b"], 3)
    t.upsert(spark.createDataFrame([(1, None, 5), (None, None, 6), (1, "x", 7)], "a int, b string, v int"))
    t.upsert(spark.createDataFrame([(None, None, 2**40), (2, None, 9)], "a int, b string, v long"))
    assert rows(t.read()) == sorted([(1, None, 5), (None, None, 2**40), (1, "x", 7), (2, None, 9)], key=repr)
    assert dict(t.read().dtypes)["v"] == "bigint"
    t.upsert(spark.createDataFrame([(1, "x")], "a int, b string"))  # a missing column: null in replaced rows
    assert (1, "x", None) in rows(t.read())
    assert wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    with pytest.raises(TypeError):
        t.upsert(spark.createDataFrame([(2**40, "x", 1)], "a long, b string, v int"))  # a key's type is its buckets'


def test_delete_retire_replace_vacuum(spark, table):
    assert table.delete(spark.createDataFrame([(5,), (7,), (7,), (12345,)], "k long")) == 2 and table.read().count() == 98
    assert table.delete(spark.createDataFrame([], "k long")) == 2
    assert table.retire(["nothing"]) == 2 and table.retire(["v"]) == 3 and table.read().columns == ["k"]
    with pytest.raises(ValueError):
        table.retire(["k"])
    assert table.replace(table.read().where("k < 10")) == 4 and table.read().count() == 8
    table.upsert(spark.createDataFrame([(3, "new")], "k long, v string"))
    assert rows(table.read().where("v is not null")) == [(3, "new")]
    assert table.vacuum(1) and table.versions() == [5] and table.read().count() == 8 and table.vacuum(1) == []
    with pytest.raises(ValueError):
        table.read(1)


def test_one_writer_wins_and_broken_ones_are_mended(spark, table):
    other = BucketTable(spark, table.path)
    assert other.keys == ["k"] and other.buckets == 8
    open(f"{table.path}/_versions/{2:012d}.claim", "w").close()  # another writer is at it, or broke off
    with pytest.raises(RuntimeError, match="another writer"):
        table.upsert(spark.createDataFrame([(1, "z")], "k long, v string"))
    assert table.read().count() == 100
    assert other.recover() and other.upsert(spark.createDataFrame([(1, "z")], "k long, v string")) == 2
    with pytest.raises(ValueError):
        BucketTable(spark, table.path, ["v"])
    with pytest.raises(ValueError):
        BucketTable(spark, table.path + "none")


def test_stream_batches_count_once(spark, tmp_path, table):
    batch = spark.createDataFrame([(1, "s", 1), (1, "t", 1), (2, "u", 0)], "k long, v string, at int")
    batch.write.parquet(str(tmp_path / "in"))
    stream = lambda mark: upsert_bucket_stream(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), table, "at", ["v"], "in", str(tmp_path / mark)).awaitTermination()
    stream("c1")
    assert table.manifest()["batches"] == {"in": 0} and {(r["k"], r["v"]) for r in table.read().where("k < 3").collect()} == {(0, "a"), (1, "t"), (2, "u")}
    n = table.versions()[-1]
    stream("c2")  # the same batch under its number
    assert table.versions()[-1] == n


def test_build_in_one_pass_keeps_unknown_rows(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "d"), ["code"], 4)
    d = dims.TableSpec("d", merge_fields=["code"], key="key", defaults={"n": ("int", -1)}, expected={"code": "string", "n": "int"})
    assert spec.merge_buckets(spark.createDataFrame([(1, 5), (2, None)], "code int, n int"), d, t) == 1
    assert {(r["code"], r["n"]) for r in t.read().collect()} == {("1", 5), ("2", -1), ("Unknown", -1)}
    spec.merge_buckets(spark.createDataFrame([("Unknown", 7)], "code string, n int"), d, t)
    assert {(r["code"], r["n"]) for r in t.read().collect()} == {("1", 5), ("2", -1), ("Unknown", 7)}
    spec.merge_buckets(spark.createDataFrame([("1", 6)], "code string, n int"), d, t)
    assert {(r["code"], r["n"]) for r in t.read().collect()} == {("1", 6), ("2", -1), ("Unknown", 7)}
    plain = dims.build_table(spark.createDataFrame([("1", 6)], "code string, n int"), d)
    assert set(rows(plain)) <= {tuple(r) for r in t.read().select(*plain.columns).collect()} | {("Unknown", -1, plain.where("code = 'Unknown'").first()["key"])}
    with pytest.raises(ValueError, match="repeated"):
        spec.merge_buckets(spark.createDataFrame([("1", 6), ("1", 7)], "code string, n int"), d, t)
    with pytest.raises(ValueError, match="merge fields missing"):
        spec.merge_buckets(spark.createDataFrame([(6,)], "n int"), d, t)
    with pytest.raises(ValueError, match="columns differ"):
        spec.merge_buckets(spark.createDataFrame([("1", "x")], "code string, n string"), dims.TableSpec("d", merge_fields=["code"], key="key", expected={"n": "int"}), t)
    with pytest.raises(ValueError, match="key column"):
        spec.merge_buckets(spark.createDataFrame([("1", 1)], "code string, key int"), dims.TableSpec("d", merge_fields=["code"], key="key"), t)
    with pytest.raises(ValueError, match="history"):
        spec.merge_buckets(plain, dims.TableSpec("h", "scd2", ["code"], tracked=["n"]), t)
    over = dims.TableSpec("d", merge_fields=["code"], key="key", write_mode="overwrite")
    spec.merge_buckets(spark.createDataFrame([("9",)], "code string"), over, t)
    assert {r["code"] for r in t.read().collect()} == {"9", "Unknown"}


def test_ranked_keys(spark):
    f = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, "zz", "b"), (4, None, None), (5, "zz", "yy"), (5, "zz", "yy")], "i int, x string, y string")
    d = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), (None, 9), ("c", None)], "n string, k int")
    out = ranked.resolve_ranked(f, [F.col("x"), F.col("y")], d, "n", {"k2": "k"}, "place")
    assert rows(out.select("i", "k2", "place")) == [(1, 1, 1), (2, 1, 2), (3, 1, 2), (4, None, None), (5, None, None), (5, None, None)]
    assert ranked.resolve_ranked(f.limit(0), [F.col("x")], d, "n", {"k2": "k"}).count() == 0
    assert ranked.resolve_ranked(f, [F.col("x")], d.limit(0), "n", {"k2": "k"}).where("k2 is not null").count() == 0
    with pytest.raises(ValueError):
        ranked.resolve_ranked(f, [F.col("x")], d, "n", {"I": "k"})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ranked.resolve_ranked(f, [F.col("x"), F.col("y")], d, "n", {"k2": "k"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the fact's, and the resolved lists'


JSON = ['{"a":{"b":7,"x y":1.50},"l":[{"id":1,"v":"x"},{"id":2,"v":{"value":"q"}}],"s":["a","b"],"n":null}', '{"a":{"b":"z"},"l":5}', "oops", None, '{"l":[]}', '{"a":1,"a":2}']


def test_records_are_parsed_once(spark):
    df = spark.createDataFrame(list(enumerate(JSON)), "i int, raw_data string")
    maps = [semi.Mapping("b", "a.b"), semi.Mapping("b_long", "a.b", "long"), semi.Mapping("x", "a.x y", "double"), semi.Mapping("l", "l"), semi.Mapping("n", "n")]
    out = variants.map_records(df, maps + [semi.Mapping(f"c{i}", f"q.{i}", "date") for i in range(15)], keep=["i"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and len(out.columns) == 21
    got = {r["i"]: r for r in out.collect()}
    assert (got[0]["b"], got[0]["b_long"], got[0]["x"], got[0]["n"]) == ("7", 7, 1.5, None) and got[0]["l"].startswith("[{") and got[1]["b"] == "z" and got[1]["b_long"] is None
    assert all(v is None for i in (2, 3, 5) for k, v in got[i].asDict().items() if k != "i")
    old = {r["i"]: r for r in semi.map_columns(df.where("i < 5"), maps[:3], keep=["i"]).collect()}
    assert all(tuple(old[i]) == tuple(got[i])[:4] for i in old)


def test_records_explode_by_levels_and_shapes(spark):
    df = spark.createDataFrame(list(enumerate(JSON)), "i int, raw_data string")
    made = variants.explode_records(df, semi.ExplodeSpec("l", [semi.Mapping("id", "id", "int")], "b", "a.b", carry=["i"]), "e")
    assert rows(made.select("i", "b", "id")) == [(0, "7", 1), (0, "7", 2)]
    assert [r[0] for r in made.orderBy("id").select(variants.one_of_shapes(F.col("e"), "v", ["value"])).collect()] == ["x", "q"]
    nested = spark.createDataFrame([('{"key":"K","changelog":{"histories":[{"id":"1","items":[{"field":"status","toString":"Done"}]},{"id":"2","items":[]}]}}',)], "raw_data string")
    first = variants.explode_records(nested, semi.CHILD_TABLES["histories"], "h")
    shape = semi.ExplodeSpec("items", [semi.Mapping("to", "toString")], "history_id", "id", "h", ["issue_key"])
    assert rows(variants.explode_records(first, shape)) == [("1", "K", "Done")]
    shapes = variants.parsed(df).orderBy("i").select(variants.shape(F.col("_v"), "l"), variants.shape(F.col("_v"), "n"), variants.shape(F.col("_v"), "a"), variants.one_of_shapes(F.col("_v"), "s", ["value"]))
    assert rows(shapes.limit(3)) == sorted([("array", "null", "object", "a, b"), ("scalar", None, "object", None), (None, None, None, None)], key=repr)
    pages = spark.createDataFrame([("e", 1, '{"d":[{"x":1},{"x":2}]}'), ("e", 2, '{"d":7}'), ("e", 3, "no")], "entity string, page_no int, body string")
    assert rows(variants.unpack_records(pages, "d").select("page_no", variants.text_at(F.col("record"), "x"))) == [(1, "1"), (1, "2")]


@pytest.mark.parametrize("name", sorted(semi.CHILD_TABLES))
def test_child_tables_by_both_ways(spark, name):
    """Every declared child table: the record is built from its own paths; both explodes give the same row."""
    s = semi.CHILD_TABLES[name]

    def put(path, value, at):
        *most, last = path.split(".")
        for p in most:
            at = at.setdefault(p, {})
        at[last] = value

    import json

    item = {}
    for m in s.mappings:
        if m.path:
            put(m.path, f"v_{m.target}", item)
    items = [item or "plain"]
    doc = {}
    if s.array_path:
        put(s.array_path, items, doc)
    else:
        doc = items
    if s.parent_path:
        put(s.parent_path, "P", doc)
    df = spark.createDataFrame([(json.dumps(doc), "P", "K"), ("{}", "Q", "K"), (None, "R", "K")], f"{s.source} string, {s.parent_name if s.parent_path is None else 'unused'} string, issue_key2 string").withColumnRenamed("issue_key2", "issue_key" if "issue_key" in s.carry else "rest")
    want = [tuple(["P", *["K" for _ in s.carry], *[f"v_{m.target}" if m.path else "plain" for m in s.mappings]])]
    assert rows(semi.explode_array(df, s)) == want and rows(variants.explode_records(df, s)) == want


def test_schema_lattice():
    kinds = list(schema_sketch.ABOVE)
    for a in kinds:
        for b in kinds:
            up = schema_sketch.joined(a, b)
            assert up == schema_sketch.joined(b, a) and schema_sketch.joined(up, a) == up and schema_sketch.joined(a, a) == a
            for c in kinds:
                assert schema_sketch.joined(schema_sketch.joined(a, b), c) == schema_sketch.joined(a, schema_sketch.joined(b, c))
    assert schema_sketch.joined("bigint", "double") == "double" and schema_sketch.joined("null", "date") == "date" and schema_sketch.joined("object", "bigint") == "any"
    assert schema_sketch.parse_kind("OBJECT<`a``b`: ARRAY<OBJECT<x: DECIMAL(3,2)>>, `c.d`: VOID>") == [("", "object"), ("`a`b`", "array"), ("`a`b`[*]", "object"), ("`a`b`[*].x", "decimal"), ("`c.d`", "null")]


def test_schema_sketches_per_load(spark):
    df = spark.createDataFrame([("1", '{"a":1,"n":{"x":true},"l":[1,2]}'), ("1", "broken"), ("2", '{"a":2.5,"n":{"x":null,"y":"t"},"w.z":1}'), ("3", None)], "load_id string, raw_data string")
    made = schema_sketch.sketch(df)
    by_hand = [schema_sketch.sketch(df.where(F.col("load_id") == x)) for x in "12"]
    assert rows(made) == rows(by_hand[0].unionByName(by_hand[1]))
    whole = schema_sketch.struct_of(schema_sketch.merged(made))
    assert whole.simpleString() == "struct<a:double,l:array<bigint>,n:struct<x:boolean,y:string>,w.z:bigint>"
    flat = semi.auto_standardize(df, carry=["load_id"], schema=whole)
    assert flat.where("a is not null").count() == 2
    got = {(r["path"], r["change"], r["before"], r["after"]) for r in schema_sketch.drift(made, ["1", "2", "3"]).where("load_id = '2'").collect()}
    assert got == {("a", "widened", "bigint", "decimal"), ("n.y", "added", None, "string"), ("`w.z`", "added", None, "bigint"), ("l", "missing", "array", None), ("l[*]", "missing", "bigint", None)}
    assert schema_sketch.drift(made, []).count() == 0 and schema_sketch.merged(made.limit(0)) == []


def test_ranges_of_all_lengths(spark):
    rng = random.Random(2)
    ranges = [(a, a + rng.choice([0, 1, 5, 100, 5000, 1_000_000]) - rng.choice([0, 0, 1]), j) for j, a in enumerate(rng.randint(-50_000, 50_000) for _ in range(200))] + [(None, 3, 900), (3, None, 901)]
    points = [(rng.randint(-60_000, 160_000), i) for i in range(500)] + [(None, 999), (7, 1000), (7, 1001)]
    some = spark.createDataFrame(ranges, "lo long, hi long, j int")
    asked = spark.createDataFrame(points, "p int, i int")
    for how in ("left", "inner"):
        want = [(i, j) for p, i in points for j in ([j for a, b, j in ranges if None not in (p, a, b) and a <= p <= b] or ([None] if how == "left" else []))]
        assert rows(intervals.join_ranges(asked, some, "p", "lo", "hi", how).select("i", "j")) == sorted(want, key=repr)
    cover = some.where("hi >= lo").select("lo", "hi", intervals.dyadic_cover(F.col("lo"), F.col("hi")).alias("c")).collect()
    for r in cover:
        cells = sorted((c["cell"] << c["level"], (c["cell"] + 1) << c["level"]) for c in r["c"])
        assert cells[0][0] == r["lo"] and cells[-1][1] == r["hi"] + 1 and all(a[1] == b[0] for a, b in zip(cells, cells[1:], strict=False))
        assert len(cells) <= 2 * max(1, (r["hi"] - r["lo"] + 1).bit_length())
    assert intervals.join_ranges(asked, some.limit(0), "p", "lo", "hi").count() == len(points)
    with pytest.raises(ValueError):
        intervals.join_ranges(asked, asked, "p", "i", "i")
    intervals.assert_disjoint(spark.createDataFrame([(1, 2, "a"), (3, 4, "a"), (2, 9, "b")], "lo int, hi int, g string"), "lo", "hi", ["g"])
    with pytest.raises(ValueError, match="overlap"):
        intervals.assert_disjoint(some.where("lo is not null and hi is not null"), "lo", "hi")


def test_scans_over_hot_keys(spark):
    rng = random.Random(3)
    data = [(None if rng.random() < 0.1 else "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 9)}", rng.randint(0, 400), i, None if rng.random() < 0.7 else rng.randint(0, 9)) for i in range(900)]
    cut = scans.Slices(spark.createDataFrame(data, "k string, t int, i int, v int"), ["k"], ["t", "i"], 7)
    last, before, total, following = {}, {}, {}, {}
    for k in {r[0] for r in data}:
        known, run, group = None, 0, sorted((r for r in data if r[0] == k), key=lambda r: r[1:3])
        for r, after in zip(group, [*group[1:], None], strict=True):
            before[r[2]] = known
            known, run = r[3] if r[3] is not None else known, run + (r[3] or 0)
            last[r[2]], total[r[2]], following[r[2]] = known, run, after and after[1]
    for made, want in ((cut.carried({"z": F.col("v")}), last), (cut.carried({"z": F.col("v")}, current=False), before), (cut.running({"z": F.col("v")}), total), (cut.following("t", "z"), following)):
        assert {r["i"]: r["z"] for r in made.collect()} == want
    sizes = [r["count"] for r in cut.rows.groupBy("_slice").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 1.5 * 900 / 7  # though one key has most rows
    empty = scans.Slices(spark.createDataFrame([], "k string, t int, i int, v int"), ["k"], ["t"])
    assert empty.running({"z": F.col("v")}).count() == empty.following("t", "z").count() == empty.carried({"z": F.col("v")}).count() == 0


def test_sliced_histories_equal_whole_ones(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("k", F.expr("case when event_id % 2 = 0 then 0 else user_id end"))
    log = events.select("k", "ts", F.col("event_type").alias("state"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("points"), (F.col("event_id") == 4).alias("seed"))
    cols = ["k", "valid_from", "valid_to", "state", "points", "is_seed", "is_current"]
    assert rows(facts.state_periods(log, "k", "ts", ["state", "points"], "seed").select(*cols)) == rows(facts.state_periods_sliced(log, "k", "ts", ["state", "points"], "seed", 5).select(*cols))
    versions = events.where("event_type = 'signup'").select("k", "ts", "event_id")
    args = (events.select("event_id", "k", "ts"), versions.withColumnRenamed("event_id", "version"), ["k"], "ts", "ts", ["version"])
    assert rows(intervals.as_of_slices(*args, slices=6)) == rows(intervals.as_of_join(*args))


def test_sweep(spark):
    import datetime as dt

    first, days = dt.date(1969, 12, 29), [dt.date(2024, 3, 1) + dt.timedelta(d * 37) for d in range(-12, 12)] + [dt.date(1969, 12, 20)]
    for r in spark.createDataFrame([(d,) for d in days], "d date").select("d", (sweep.weekdays_before(F.col("d")) - sweep.weekdays_before(F.lit(first))).alias("n")).collect():
        span = range((r["d"] - first).days) if r["d"] >= first else range((r["d"] - first).days, 0)
        assert r["n"] == sum((first + dt.timedelta(x)).weekday() < 5 for x in span) * (1 if r["d"] >= first else -1)
    data = [("r", "2024-01-01", "2024-01-10", 2.0), ("r", "2024-01-05", "2024-01-06", 3.0), ("r", "2024-01-20", "2024-01-21", 1.0), ("s", "2024-02-01", None, 1.0), ("s", "2024-02-03", "2024-02-01", 1.0), (None, "2024-02-05", "2024-02-05", None)]
    df = spark.createDataFrame(data, "r string, a string, b string, w double")
    steps = sweep.load_steps(df, ["r"], "a", "b", "w", slices=3)
    assert sorted(tuple(map(str, x)) for x in steps.collect()) == [("None", "2024-02-05", "2024-02-06", "0.0", "1", "1"), ("r", "2024-01-01", "2024-01-05", "2.0", "1", "4"), ("r", "2024-01-05", "2024-01-07", "5.0", "2", "1"), ("r", "2024-01-07", "2024-01-11", "2.0", "1", "3"), ("r", "2024-01-20", "2024-01-22", "1.0", "1", "0")]
    assert {(r["r"], r["conflict_days"], r["busy_days"], r["peak"]) for r in sweep.overload(steps, ["r"], F.lit(4.0)).collect()} == {(None, 0, 1, 0.0), ("r", 1, 8, 5.0)}
    days = calendar.working_calendar(calendar.date_dimension(spark, "2024-01-01", "2024-12-31"), spark.sql("select date'2024-01-02' date"))
    assert {(str(r["from_day"]), r["work_days"]) for r in sweep.load_steps(df, ["r"], "a", "b", "w", days).where("r = 'r'").collect()} == {("2024-01-01", 3), ("2024-01-05", 1), ("2024-01-07", 3), ("2024-01-20", 0)}
    assert sweep.load_steps(df.limit(0), ["r"], "a", "b", "w").count() == 0
    # rows in proportion to intervals, not to their days
    long = spark.range(40).selectExpr("id % 3 r", "date_add(date'2000-01-01', cast(id as int)) a", "date_add(date'2000-01-01', cast(id as int) + 30000) b", "1.0 w")
    assert sweep.load_steps(long, ["r"], "a", "b", "w").count() <= 80


def test_load_steps_equal_the_days(spark):
    one = {r[0]: r[1] for r in QUERIES["conflict_days"](spark, SF).collect()}
    other = {r["l_suppkey"]: r["conflict_days"] for r in QUERIES["load_steps"](spark, SF).collect() if r["conflict_days"]}
    assert one == other and one


def test_distinct_bitmaps(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice([None, rng.randint(-5, 5), rng.randint(0, 10**12)])) for _ in range(400)]
    df = spark.createDataFrame(data, "x string, y int, item long")
    made = bitmaps.distinct_bitmaps(df, "item", ["x", "y"])
    got = rows(bitmaps.distinct_matrix(made, ["x", "y"]).select("x", "y", "level", "items"))
    want = []
    for level, key in ((2, lambda r: (r[0], r[1])), (1, lambda r: (r[0], None)), (0, lambda r: (None, None))):
        groups = {}
        for r in data:
            if r[2] is not None:
                groups.setdefault(key(r), set()).add(r[2])
        want += [(*k, level, len(v)) for k, v in groups.items()]
    assert got == sorted(want, key=repr)
    halves = bitmaps.distinct_bitmaps(df.where("y < 2"), "item", ["x", "y"]).unionByName(bitmaps.distinct_bitmaps(df.where("y >= 1"), "item", ["x", "y"]))
    assert rows(bitmaps.distinct_matrix(bitmaps.merge_bitmaps(halves, ["x", "y"]), ["x", "y"]).select("x", "y", "level", "items")) == got


def rolled_plainly(data):
    ids = {r[0] for r in data}
    up, val = {r[0]: r[1] if r[1] in ids else None for r in data}, {r[0]: r[2] for r in data}
    found, place = {i: [] for i in ids}, {}
    for i in ids:
        j, d = i, 0
        while j is not None:
            if val[i] is not None:
                found[j].append(val[i])
            if up[j] is None:
                place[i] = (d, j)
            j, d = up[j], d + 1
    return {i: (min(v) if v else None, max(v) if v else None, sum(v) if v else None, *place[i]) for i, v in found.items()}


@pytest.mark.parametrize("kind", ["bush", "chain"])
def test_deep_rollup(spark, kind):
    rng = random.Random(5)
    n = 200
    data = [(i * 7 % 997, None if i == 0 or rng.random() < 0.02 else (i - 1 if kind == "chain" or rng.random() < 0.5 else rng.randint(0, i - 1)) * 7 % 997, None if rng.random() < 0.5 else rng.randint(-50, 50)) for i in range(n)] + [(5000, 77_777, 3)]
    df = spark.createDataFrame(data, "id long, p long, v long")
    values = {"lo": ("v", "min"), "hi": ("v", "max"), "t": ("v", "sum")}
    assert {r["id"]: (r["lo"], r["hi"], r["t"], r["depth"], r["root"]) for r in deep_tree.deep_rollup(df, "id", "p", values, small=60).collect()} == rolled_plainly(data)
    made = deep_tree._Contraction(df, "id", "p", values, 60, 200)
    made.run()
    assert sum(t.count() for t in made.tables) < 16 * n


@pytest.mark.parametrize("near", [True, False])
@pytest.mark.parametrize("block_rows", [0, 23, 1000])
def test_deep_rollup_by_blocks(spark, near, block_rows):
    rng = random.Random(8)
    key = (lambda i: i) if near else (lambda i: i * 7919 % 100_003)
    data = [(key(i), None if i == 0 or rng.random() < 0.01 else key(max(0, i - rng.choice([1, 1, 1, 2, 3, 40]))), None if rng.random() < 0.6 else rng.randint(-50, 50)) for i in range(400)] + [(900_000, 77_777_777, 3)]
    df = spark.createDataFrame(data, "id long, p long, v long")
    values = {"lo": ("v", "min"), "hi": ("v", "max"), "t": ("v", "sum")}
    got = deep_tree.deep_rollup(df, "id", "p", values, small=5, block_rows=block_rows)
    assert {r["id"]: (r["lo"], r["hi"], r["t"], r["depth"], r["root"]) for r in got.collect()} == rolled_plainly(data)


def test_a_chain_of_neighbouring_keys_takes_no_rounds(spark):
    """6,000 nodes in 20 blocks: what blocks leave is finished in the driver; before, 15 rounds or more of four tables each."""
    data = [(i, i - 1 - i % 2 if i > 1 else 0 if i else None, i % 10) for i in range(6000)]
    made = deep_tree._Contraction(spark.createDataFrame(data, "id long, p long, v long"), "id", "p", {"t": ("v", "sum")}, 100, 200)
    made.block_rows = 300
    assert made.run().agg({"depth": "max"}).collect()[0][0] == max(r[3] for r in rolled_plainly(data).values())
    assert len(made.tables) <= 6


def test_cycles_over_blocks_are_named(spark):
    loop = [(i, (i + 1) % 90) for i in range(90)] + [(100 + i, i % 90) for i in range(40)] + [(1000, None), (1001, 1000)]
    for block_rows in (10, 1000):
        with pytest.raises(ValueError, match="cycle, of") as e:
            deep_tree.deep_rollup(spark.createDataFrame(loop, "id long, p long"), "id", "p", {}, small=1, block_rows=block_rows)
        assert all(0 <= int(x) < 90 for x in str(e.value).split("[")[1].rstrip("]").split(", "))


def test_deep_rollup_of_odd_tables(spark):
    make = lambda data: spark.createDataFrame(data, "id long, p long")
    assert deep_tree.deep_rollup(make([]), "id", "p", {}).count() == 0
    loop = [(i, (i + 1) % 30) for i in range(30)] + [(100 + i, i % 30) for i in range(40)] + [(1000, None), (1001, 1000)]
    for small in (1, 1000):
        with pytest.raises(ValueError, match="cycle, of") as e:
            deep_tree.deep_rollup(make(loop), "id", "p", {}, small=small)
        assert all(0 <= int(x) < 30 for x in str(e.value).split("[")[1].rstrip("]").split(", "))
    with pytest.raises(ValueError, match=r"\[3\]"):
        deep_tree.deep_rollup(make([(3, 3)]), "id", "p", {})
    with pytest.raises(ValueError, match="null"):
        deep_tree.deep_rollup(make([(None, 3)]), "id", "p", {})
    with pytest.raises(ValueError, match="repeated"):
        deep_tree.deep_rollup(make([(1, 3), (1, 2)]), "id", "p", {})


FAIR = """
import sys, tempfile, time
from pyspark.sql import SparkSession, functions as F
from tidemark.sources.sinks import fair_settings, run_fairly
made = fair_settings({"small": (4, 1)}, tempfile.mkdtemp() + "/pools.xml")
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(map=made).getOrCreate()
assert spark.sparkContext._jsc.sc().getSchedulingMode().toString() == "FAIR"
wait = lambda tasks, s: spark.range(tasks * 10, numPartitions=tasks).mapInArrow(lambda b: ([time.sleep(s)], b)[1], "id long").count()
def small():
    time.sleep(1.5)
    return wait(2, 0.1)
def huge():
    return wait(500, 0.3)
def broken():
    raise ValueError("no")
wait(2, 0)
ends = run_fairly(spark, {"large": lambda: wait(24, 0.4), "small": small, "broken": broken}, workers=3)
print("ORDER", [(r.name, r.status) for r in ends])
ends = run_fairly(spark, {"huge": huge, "small": small}, workers=2, limit=4)
print("LIMIT", sorted((r.name, r.status) for r in ends), max(r.seconds for r in ends) < 20)
"""


def test_fair_pools():
    """A small table that began after a large one ends before it; one beyond its limit is cancelled alone."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", FAIR], capture_output=True, text=True, timeout=180, env=os.environ | {"PYTHONPATH": root}, check=False)
    assert "ORDER [('broken', 'failed'), ('small', 'succeeded'), ('large', 'succeeded')]" in got.stdout, got.stderr[-2000:]
    assert "LIMIT [('huge', 'cancelled'), ('small', 'succeeded')] True" in got.stdout


def test_pools_are_reported_without_fair_mode(spark, tmp_path):
    assert "FAIR" in fair_settings({"a": (1, 0)}, str(tmp_path / "p.xml"))["spark.scheduler.mode"] and "<weight>1" in (tmp_path / "p.xml").read_text()
    assert {(r.name, r.status) for r in run_fairly(spark, {"a": lambda: spark.range(3).count(), "b": lambda: 1 / 0})} == {("a", "succeeded"), ("b", "failed")}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_standardised_ties_are_settled_by_all_columns(spark):
    texts = ['{"id":1,"at":5,"a":"x","b":1}', '{"id":1,"at":5,"a":"x","b":3}', '{"id":1,"at":5,"a":"x","b":2}', '{"id":1,"at":4,"a":"z","b":9}']
    for data in (texts, texts[::-1]):
        df = spark.createDataFrame([(t,) for t in data], "raw_data string")
        assert [(r["a"], r["b"]) for r in semi.run_auto_standardize(df, ["id"], "at").collect()] == [("x", 3)]
