"""Parameterised builders of the usual dimensions and facts; each returns rows for ``build_table``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import facts
from tidemark.operators.intervals import join_points
from tidemark.operators.tree import enrich, rollup_dates_by_path
from tidemark.sources.work import partitions

#: Priority bands by keyword, first fit wins: words contained, prefix, sort order, band, band order.
BANDS = [(("highest", "critical"), "p1", 1, "Critical", 1), (("high",), "p2", 2, "High", 2), (("medium",), "p3", 3, "Medium", 3), (("lowest",), "p5", 5, "Low", 4), (("low",), "p4", 4, "Low", 4)]


def keyword_bands(df: DataFrame, name: str, bands: list[tuple] = BANDS) -> DataFrame:
    """sort_order, band, band_sort by a ladder of keywords; nothing fits: 9, Unknown, 9."""
    low = F.lower(F.col(name))
    fits = [F.coalesce(low.startswith(prefix), F.lit(False)) | _any([low.contains(w) for w in words]) for words, prefix, *_ in bands]

    def ladder(at: int, rest: object) -> Column:
        out = F.lit(rest)
        for fit, band in reversed(list(zip(fits, bands, strict=True))):
            out = F.when(fit, F.lit(band[at])).otherwise(out)
        return out

    return df.withColumns({"sort_order": ladder(2, 9), "band": ladder(3, "Unknown"), "band_sort": ladder(4, 9)})


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def vocabulary(spark: SparkSession, stages: dict[str, list[str]]) -> DataFrame:
    """name, stage, stage_sort, name_sort of ordered lists; a name listed twice keeps its first place."""
    seen, rows = set(), []
    for i, (stage, names) in enumerate(stages.items(), 1):
        for n in names:
            if (k := n.strip().lower()) not in seen:
                seen.add(k)
                rows.append((k, stage, i, len(rows) + 1))
    return spark.createDataFrame(rows, "name string, stage string, stage_sort int, name_sort int")


def map_vocabulary(df: DataFrame, column: str, words: DataFrame, fallback: Column, fallback_sort: int = 99) -> DataFrame:
    """Stages by trimmed, lower-cased name; others get the fallback stage and ``is_mapped`` false."""
    out = df.join(F.broadcast(words), F.lower(F.trim(column)) == F.col("name"), "left")
    return out.withColumns({"is_mapped": F.col("stage").isNotNull(), "stage": F.coalesce("stage", fallback), "stage_sort": F.coalesce("stage_sort", F.lit(fallback_sort)), "name_sort": F.coalesce("name_sort", F.lit(fallback_sort * 10))}).drop("name")


def unmapped(df: DataFrame, column: str, words: DataFrame) -> DataFrame:
    return df.select(column).distinct().join(F.broadcast(words), F.lower(F.trim(column)) == F.col("name"), "left_anti")


def status_groups(df: DataFrame, name: str, category: str) -> DataFrame:
    """status_group, flow_state, is_done, is_blocked from a status's name and category."""
    low, kind = F.lower(F.col(name)), F.lower(F.col(category))
    done, blocked = F.coalesce(kind == "done", F.lit(False)), _any([low.contains("block"), low.contains("hold")])
    group = F.when(done, "Done").when(blocked, "Blocked").when(kind == "to do", "Not started").otherwise("In progress")
    return df.withColumns({"status_group": group, "flow_state": F.when(done, "Closed").when(kind == "to do", "Waiting").otherwise("Active"), "is_done": done, "is_blocked": blocked})


def people(directory: DataFrame, involved: DataFrame, person: str, name: str, capacity: float = 8.0) -> DataFrame:
    """Directory rows of people who are involved, and one row for each who is missing from the directory."""
    ids = involved.where(F.col(person).isNotNull())
    known = directory.join(ids.select(person).distinct(), person, "left_semi").select(person, name, "active")
    rest = ids.join(directory, person, "left_anti").groupBy(person).agg(F.max(name).alias(name), F.max("active").alias("active"))
    return known.unionByName(rest).withColumn("daily_capacity", F.lit(capacity))


def named_dimension(df: DataFrame, name: str, member: str) -> DataFrame:
    """A dimension keyed by a name that facts carry, with the smallest id that has it."""
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(member).alias(member))


def renamed(df: DataFrame, columns: dict[str, str], spellings: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Chosen columns under new names, with odd spellings of values mended."""
    out = df.select(*[F.col(c).alias(n) for c, n in columns.items()])
    for c, fix in (spellings or {}).items():
        out = out.replace(fix, subset=[c])
    return out


def sentence_case(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def test_statuses(df: DataFrame, name: str, passed: list[str], not_run: str = "Not run") -> DataFrame:
    """Statuses in sentence case with coverage flags, and a row for tests that never ran."""
    rows = df.select(sentence_case(F.col(name)).alias("status"), F.lower(name).isin([p.lower() for p in passed]).alias("is_passed"), F.lit(True).alias("is_run")).distinct()
    return rows.unionByName(df.sparkSession.range(1).select(F.lit(not_run).alias("status"), F.lit(False).alias("is_passed"), F.lit(False).alias("is_run"))).dropDuplicates(["status"])


#: Tracker statuses with their coverage and sort order. Any other: Not run, 9; tests without a run: Not run, 6.
COVERAGE = {"PASSED": ("Passed", 1), "FAILED": ("Failed", 2), "BLOCKED": ("Blocked", 3), "EXECUTING": ("Not run", 4), "TO DO": ("Not run", 5)}


def test_status_dimension(df: DataFrame, name: str, description: str) -> DataFrame:
    """A row a tracker status: status (sentence case), description, coverage, is_final, is_pass, is_fail, is_blocked, is_not_run,
    sort_order; and one for tests without a run. Repeated names give one row, with the least description."""
    known = F.create_map(*[F.lit(x) for k, (cover, order) in COVERAGE.items() for x in (k, f"{order}{cover}")])
    found = F.coalesce(known[F.col(name)], F.lit("9Not run"))
    rows = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(description).alias("description"))
    rows = rows.select(sentence_case(F.col(name)).alias("status"), F.coalesce("description", F.lit("Unknown")).alias("description"), F.substr(found, F.lit(2)).alias("coverage"), F.substring(found, 1, 1).cast("int").alias("sort_order"), F.lit(False).alias("is_not_run"))
    none = df.sparkSession.range(1).select(F.lit("Not run").alias("status"), F.lit("Test has not been executed yet").alias("description"), F.lit("Not run").alias("coverage"), F.lit(6).alias("sort_order"), F.lit(True).alias("is_not_run"))
    flags = {"is_final": F.col("coverage").isin("Passed", "Failed"), "is_pass": F.col("coverage") == "Passed", "is_fail": F.col("coverage") == "Failed", "is_blocked": F.col("coverage") == "Blocked"}
    return rows.unionByName(none).withColumns(flags)


def roles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("Lead", 1), ("Involved", 2), ("Reporter", 3)], "role string, role_sort int")


def joined_list(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Distinct values of a group, sorted, as one text."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), ", ").alias(out))


def work_items(items: DataFrame, predecessors: DataFrame, persons: DataFrame, tests: DataFrame | None = None, columns: list[str] | None = None, **tree: object) -> DataFrame:
    """Items with their predecessors' and people's lists, a missing-dates flag, the hierarchy's columns and, if there are any,
    attributes of those that are tests. columns: the ones to return, in order; a name that isn't there is a null text."""
    out = items.withColumn("missing_dates", F.col("start").isNull() | F.col("end").isNull())
    out = out.join(joined_list(predecessors, ["id"], "linked", "predecessors"), "id", "left").join(joined_list(persons, ["id"], "person", "people"), "id", "left")
    out = out.join(tests, "id", "left") if tests is not None else out
    out = out.withColumns({c: F.coalesce(c, F.lit("None")) for c in ("predecessors", "people")})
    made = enrich(out, "id", "parent", "code", "rank", "type_rank", **tree)
    return made.select(*[F.col(c) if c in made.columns else F.lit(None).cast("string").alias(c) for c in columns]) if columns else made


def schedule_fact(items: DataFrame, changes: DataFrame, links: DataFrame, as_of: str, active: list[str]) -> DataFrame:
    """First active and approval instants, link coverage, slip, lead, overdue, hours and rolled-up dates.

    items: id, path, start, end, actual_start, actual_end, created, resolved, estimate_seconds. changes: id, at, status.
    links: id, linked, linked_type.
    """
    first = changes.groupBy("id").agg(F.min(F.when(F.col("status").isin(active), F.col("at"))).alias("first_active"), F.min(F.when(F.lower("status").like("%approv%"), F.col("at"))).alias("first_approved"))
    cover = links.select("id", "linked", "linked_type").distinct().groupBy("id").agg(F.count_if(F.col("linked_type") == "Test").alias("tests"), F.count_if(F.col("linked_type") == "Bug").alias("defects"))
    day, now = lambda c: F.col(c).cast("date"), F.lit(as_of).cast("date")
    out = items.join(first, "id", "left").join(cover, "id", "left").na.fill(0, ["tests", "defects"])
    out = out.withColumns({
        "has_tests": F.col("tests") > 0, "has_defects": F.col("defects") > 0, "slip_days": F.datediff(F.coalesce("actual_end", F.lit(None).cast("date")), day("end")),
        "lead_days": F.datediff(day("first_approved"), day("created")), "is_done": F.col("resolved").isNotNull(), "is_overdue": F.coalesce(F.col("resolved").isNull() & (day("end") < now), F.lit(False)), "estimate_hours": F.col("estimate_seconds") / 3600.0,
    })
    rolled = rollup_dates_by_path(out, "path", "start", "end")
    return rolled.withColumn("duration_days", F.datediff("rolled_end", "rolled_start") + 1)


def run_fact(runs: DataFrame, test: str, statuses: DataFrame) -> DataFrame:
    """Runs with their status flags and the latest run of each test marked."""
    order = [F.col("started_on").desc_nulls_last(), F.col("finished_on").desc_nulls_last(), F.col("run_id").desc()]
    flagged = facts.latest_flag(runs, [test], order)
    return flagged.join(F.broadcast(statuses), F.lower("status_name") == F.lower("status"), "left").withColumn("is_finished", F.col("finished_on").isNotNull())


def worklog_fact(logs: DataFrame, allocations: DataFrame) -> DataFrame:
    """Distinct log rows with the author's role on the item, or Other, and hours. One exchange of each side, into partitions
    by row counts: what a task sorts doesn't grow with the tables."""
    pair, n = ["resource", "item"], partitions(logs)
    roles = allocations.select(*pair, "role").repartition(n, *pair)
    return logs.repartition(n, *pair).distinct().join(roles, pair, "left").withColumns({"role": F.coalesce("role", F.lit("other")), "hours": F.col("seconds") / 3600.0})


def pivot_values(df: DataFrame, keys: list[str], place: str, value: str, names: dict[object, str]) -> DataFrame:
    """One row a key, one column a place, by conditional aggregation."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(place) == p, F.col(value))).alias(n) for p, n in names.items()])


def account_dimension(ledger: DataFrame, dimensions: DataFrame, mapping: DataFrame, account: str, set_id: str) -> DataFrame:
    """Accounts by dimension set with four named values and the first mapping that fits: by value, else by account."""
    names = {i: f"dim_{i}" for i in range(1, 5)}
    wide = pivot_values(dimensions, [set_id], "place", "code", names)
    rows = ledger.select(account, set_id).distinct().join(wide, set_id, "left")
    exact = mapping.where("dim_1 is not null").select(account, "dim_1", F.col("mapped").alias("_exact"))
    plain = mapping.where("dim_1 is null").select(account, F.col("mapped").alias("_plain"))
    return rows.join(exact, [account, "dim_1"], "left").join(plain, account, "left").withColumn("mapped", F.coalesce("_exact", "_plain", F.lit("Unknown"))).drop("_exact", "_plain")


def ledger_fact(entries: DataFrame, registers: DataFrame, benefits: DataFrame, keys: list[str], overrides: dict[str, str] | None = None, width: int = 1000) -> DataFrame:
    """Entries with the register whose range holds them and the benefit of their composite key, Unknown where none."""
    fixed = benefits.replace(overrides, subset=["benefit"]) if overrides else benefits
    out = join_points(entries, registers, "entry_no", "from_entry", "to_entry", width).join(fixed, keys, "left")
    return out.withColumn("benefit", F.coalesce("benefit", F.lit("Unknown")))
