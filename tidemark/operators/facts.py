"""Fact builders: state periods, allocations, link bridges, run facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.calendar import add_working_days, expand_days
from tidemark.operators.scans import Slices
from tidemark.operators.sweep import weekdays_before
from tidemark.sources.work import partitions


def state_periods(events: DataFrame, entity: str, at: str, tracked: list[str], seed: str | None = None) -> DataFrame:
    """Half-open periods [valid_from, valid_to) of full states from a change log.

    Events of one instant become one (largest value of each column); each tracked value is carried on until it changes; the
    last period is open. seed: a boolean column that marks an entity's first state. One window, one sort per entity.
    """
    flag = F.max(F.col(seed).cast("int")) == 1 if seed else F.lit(False)
    once = events.groupBy(entity, at).agg(*[F.max(c).alias(c) for c in tracked], flag.alias("is_seed"))
    w = Window.partitionBy(entity).orderBy(at)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = once.select(entity, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"), *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in tracked], "is_seed")
    return filled.withColumn("is_current", F.col("valid_to").isNull())


def state_periods_sliced(events: DataFrame, entity: str, at: str, tracked: list[str], seed: str | None = None, slices: int | None = None) -> DataFrame:
    """``state_periods`` for entities with histories of any length: time is cut into slices, and each value a slice ends with
    is carried into the next, so one entity with half of all events is not one task. Two range exchanges of the instants."""
    flag = F.max(F.col(seed).cast("int")) == 1 if seed else F.lit(False)
    once = events.groupBy(entity, F.col(at).alias("valid_from")).agg(*[F.max(c).alias(c) for c in tracked], flag.alias("is_seed"))
    filled = Slices(once, [entity], ["valid_from"], slices).carried({f"_{c}": F.col(c) for c in tracked})
    filled = filled.select(entity, "valid_from", *[F.col(f"_{c}").alias(c) for c in tracked], "is_seed")
    ended = Slices(filled, [entity], ["valid_from"], slices).following("valid_from", "valid_to")
    return ended.select(entity, "valid_from", "valid_to", *tracked, "is_seed", F.col("valid_to").isNull().alias("is_current"))


def first_states(entities: DataFrame, log: DataFrame, entity: str, created: str, at: str, tracked: dict[str, tuple[str, str]]) -> DataFrame:
    """The state that each entity began in, as rows of its change log: entity, ``at`` (its creation), tracked values, is_seed.

    tracked: by column, (the log's column of old values, the entities' column of present ones). What a column began with is
    the old value of its earliest change (a row where the column isn't null; ties by new, then old value), or, where nothing
    changed it or no old value is known, the present value. One aggregation of the log, one join with the entities.
    """

    def began(c: str, old: str) -> Column:
        return F.min_by(F.col(old), F.when(F.col(c).isNotNull(), F.struct(at, c, old)))

    first = log.groupBy(F.col(entity).alias("_entity")).agg(*[began(c, old).alias(f"_first_{c}") for c, (old, _) in tracked.items()])
    rows = entities.join(first, F.col(entity) == F.col("_entity"), "left")
    return rows.select(entity, F.col(created).alias(at), *[F.coalesce(f"_first_{c}", now).alias(c) for c, (_, now) in tracked.items()], F.lit(True).alias("is_seed"))


def aged_periods(periods: DataFrame, waiting: Column, planned: Column, is_done: Column, resolved: Column, as_of: str, calendar: DataFrame) -> DataFrame:
    """Periods with their end, ``days_in_period`` and ``working_days``, both counted from the planned start where a period only
    waits for it, so that what isn't due yet has no age.

    A period ends where the next one begins; a last one that is done ends when it was resolved (if unknown, where it began),
    any other stays open and is counted to ``as_of``. Working days of last periods include their last day. A null flag is false.
    """
    waits, done = F.coalesce(waiting, F.lit(False)), F.coalesce(is_done, F.lit(False))
    began = F.greatest(F.col("valid_from"), F.when(waits, planned.cast("timestamp")))
    closed = F.coalesce("valid_to", F.when(done, F.coalesce(resolved.cast("timestamp"), F.col("valid_from"))))
    counted = F.coalesce(closed, F.lit(as_of).cast("timestamp"))
    until = F.date_add(counted.cast("date"), F.when(F.col("valid_to").isNull(), 1).otherwise(0))
    days = F.greatest(F.lit(0.0), (F.unix_timestamp(counted) - F.unix_timestamp(began)) / 86400.0)
    rows = periods.select("*", began.cast("date").alias("_began"), until.alias("_until"), closed.alias("_closed"), days.alias("days_in_period"))
    return add_working_days(rows, "_began", "_until", calendar).withColumn("valid_to", F.col("_closed")).drop("_began", "_until", "_closed")


def close_done(periods: DataFrame, is_done: Column, resolved: Column, as_of: str) -> DataFrame:
    """Terminal periods end at their resolution, others stay open; days_in_period counts to the end or to ``as_of``."""
    end = F.coalesce("valid_to", F.when(is_done, F.coalesce(resolved, F.col("valid_from"))))
    seconds = F.unix_timestamp(F.coalesce(end, F.lit(as_of).cast("timestamp"))) - F.unix_timestamp("valid_from")
    return periods.withColumns({"valid_to": end, "days_in_period": F.greatest(F.lit(0.0), seconds / 86400.0)})


def flag_reopened(periods: DataFrame, entity: str, is_done: Column) -> DataFrame:
    """is_reopen: a period that isn't done after one that was."""
    before = F.lag(is_done).over(Window.partitionBy(entity).orderBy("valid_from"))
    return periods.withColumn("is_reopen", F.coalesce(before & ~is_done, F.lit(False)))


def role_allocations(leads: DataFrame, involved: DataFrame, resource: str, item: str) -> DataFrame:
    """Leads with weight 1 and others involved with weight 0, each pair once."""
    first = leads.select(resource, item).where(F.col(resource).isNotNull()).distinct()
    rest = involved.select(resource, item).where(F.col(resource).isNotNull()).distinct().join(first, [resource, item], "left_anti")
    return first.withColumns({"role": F.lit("lead"), "weight": F.lit(1)}).unionByName(rest.withColumns({"role": F.lit("involved"), "weight": F.lit(0)}))


def _block(day: Column) -> Column:
    """Eight weeks from a Monday, numbered."""
    return F.floor((F.unix_date(day.cast("date")) + 3) / 56)  # 1970-01-01 was a Thursday


def day_allocations(allocations: DataFrame, resource: str, item: str, role: str, weight: str, start: str, end: str, hours: str, calendar: DataFrame | None = None) -> DataFrame:
    """The strongest role of each pair, one row a weekday (or working day), hours spread evenly and
    weighted. Weekdays are counted before they are exploded; only a calendar's working days need a window.

    ``alloc_block`` numbers eight weeks from a Monday. Intervals are cut at its bounds and exchanged by resource and block
    before their days are listed, so groups by resource, block and day (or week) need no exchange of days.
    """
    n = partitions(allocations)
    w = Window.partitionBy(resource, item).orderBy(F.col(weight).desc(), role)
    strongest = allocations.repartition(n, resource, item).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if calendar is not None:
        days = expand_days(strongest, start, end, "alloc_date", calendar).withColumn("_days", F.count("*").over(Window.partitionBy(resource, item)))
        days = days.withColumn("alloc_block", _block(F.col("alloc_date")))
    else:
        a, b = F.col(start).cast("date"), F.col(end).cast("date")
        whole = strongest.where(a.isNotNull() & b.isNotNull() & (b >= a)).withColumn("_days", weekdays_before(F.date_add(b, 1)) - weekdays_before(a))
        pieces = whole.withColumn("alloc_block", F.explode(F.sequence(_block(a), _block(b)))).repartition(n, resource, "alloc_block")
        first = F.date_from_unix_date((F.col("alloc_block") * 56 - 3).cast("int"))
        days = expand_days(pieces.withColumns({"_first": F.greatest(a, first), "_last": F.least(b, F.date_add(first, 55))}), "_first", "_last", "alloc_date").drop("_first", "_last")
    return days.withColumn("allocated_hours", F.coalesce(hours, F.lit(0)) / F.col("_days") * F.col(weight)).drop("_days")


def latest_flag(df: DataFrame, keys: list[str], order: list[Column], out: str = "is_latest") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def link_bridge(links: DataFrame, items: DataFrame, item: str, blocking: str = "Blocks") -> DataFrame:
    """Links from both sides, labelled by their direction, and a ``(none)`` row for each item that nothing blocks.

    links: item, outward, inward, link_type, outward_label, inward_label; counted and read three times, so give written ones.
    items: every item once. Each side is exchanged once, by item, into partitions by row counts.
    """
    out, n = F.col("outward").isNotNull(), partitions(links)
    rows = links.where("outward is not null or inward is not null").select(
        item, F.coalesce("outward", "inward").alias("linked"), "link_type", F.when(out, "Outward").otherwise("Inward").alias("direction"), F.when(out, F.col("outward_label")).otherwise(F.col("inward_label")).alias("label")
    )
    blocked = links.where((F.col("link_type") == blocking) & F.col("inward").isNotNull()).select(item).repartition(n, item).distinct()
    gaps = items.select(item).join(blocked, item, "left_anti").select(item, F.lit("(none)").alias("linked"), F.lit(blocking).alias("link_type"), F.lit("Inward").alias("direction"), F.lit("is blocked by").alias("label"))
    known = rows.repartition(n, item).distinct().join(blocked.withColumn("has_blocker", F.lit(True)), item, "left").withColumn("has_blocker", F.coalesce("has_blocker", F.lit(False)))
    return known.unionByName(gaps.withColumn("has_blocker", F.lit(False)))


def latest_status(runs: DataFrame, test: str) -> DataFrame:
    """``test`` and the status name of its latest run, by start, end and run id, nulls first. No window: a maximum, combined
    before the exchange, so a test with very many runs is no task of its own."""
    newest = F.max_by("status_name", F.struct("started_on", "finished_on", "run_id"))
    return runs.where(F.col(test).isNotNull()).groupBy(test).agg(newest.alias("status_name"))


def with_test_statuses(bridge: DataFrame, runs: DataFrame, statuses: DataFrame, item: str, test: str, parts: int | None = None) -> DataFrame:
    """A link bridge with the latest test status of both ends: ``linked_status`` (none: Unknown) and ``item_status`` (none: N/A),
    and ``lacks_blocker``: the item's own status is Blocked, but nothing is recorded that blocks it.

    statuses: the status dimension, whose ``status`` is matched in any case; a run with another status counts as none.
    parts: how many partitions the bridge's rows are joined in, else the session's.
    """
    named = latest_status(runs, test).join(F.broadcast(statuses.select("status")), F.lower("status_name") == F.lower("status"))
    ends = lambda key, out: named.select(F.col(test).alias(key), F.col("status").alias(out))
    dealt = lambda rows, key: rows.repartition(parts, key) if parts else rows
    rows = dealt(bridge, "linked").join(ends("linked", "linked_status"), "linked", "left")
    rows = dealt(rows, item).join(ends(item, "item_status"), item, "left")
    rows = rows.withColumns({"linked_status": F.coalesce("linked_status", F.lit("Unknown")), "item_status": F.coalesce("item_status", F.lit("N/A"))})
    return rows.withColumn("lacks_blocker", (F.col("item_status") == "Blocked") & ~F.col("has_blocker"))
