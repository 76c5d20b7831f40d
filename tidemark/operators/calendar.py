"""Calendars: days, weeks, fiscal periods, holidays, working days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bank holidays given once.
ONE_OFF_HOLIDAYS = ["2022-06-02", "2022-06-03", "2022-09-19", "2023-05-08"]


def date_dimension(spark: SparkSession, start: str, end: str, fiscal_start: int = 1) -> DataFrame:
    d, monday = F.col("date"), F.trunc("date", "week")
    fiscal_year = F.year(d) + (F.lit(0) if fiscal_start == 1 else (F.month(d) >= fiscal_start).cast("int"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    return days.select(
        "date", F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short_name"), F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("week_of_year"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"), monday.alias("week_start_date"), F.date_add(monday, 6).alias("week_end_date"),
        F.concat(F.date_format(monday, "MMM yyyy"), F.lit(" "), F.dayofmonth(monday), F.lit("-"), F.dayofmonth(F.date_add(monday, 6))).alias("week_label"),
        fiscal_year.alias("fiscal_year"), (F.floor(F.pmod(F.month(d) - fiscal_start, F.lit(12)) / 3) + 1).cast("int").alias("fiscal_quarter"),
    )


def add_sentinel_date(days: DataFrame, sentinel: str = "1900-01-01") -> DataFrame:
    row = days.sparkSession.range(1).select(F.lit(sentinel).cast("date").alias("date"))
    return days.unionByName(row.join(days.select("date"), "date", "left_anti"), allowMissingColumns=True)


def calendar_end(dates: DataFrame, column: str, today: str, months: int = 24) -> str:
    """The last day a calendar needs: months after the later of today and the latest date."""
    now = F.lit(today).cast("date")
    return str(dates.agg(F.add_months(F.greatest(F.coalesce(F.max(F.col(column).cast("date")), now), now), months)).first()[0])


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _weekday(d: Column) -> Column:
    return F.weekday(d)  # Monday is 0


def _off_weekend(d: Column) -> Column:
    return F.date_add(d, F.when(_weekday(d) == 5, 2).when(_weekday(d) == 6, 1).otherwise(0))


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday by the golden number, the epact and the paschal full moon's week day."""
    century = F.floor(year / 100)
    golden = F.pmod(year, F.lit(19))
    epact = F.pmod(century - F.floor(century / 4) - F.floor((8 * century + 13) / 25) + 19 * golden + 15, F.lit(30))
    moon = epact - F.floor(epact / 28) * (1 - F.floor(F.lit(29) / (epact + 1)) * F.floor((21 - golden) / 11))
    sunday = F.pmod(year + F.floor(year / 4) + moon + 2 - century + F.floor(century / 4), F.lit(7))
    return F.date_add(_day(year, 3, 28), (moon - sunday).cast("int"))


def holidays(spark: SparkSession, first: int, last: int, region: str = "uk") -> DataFrame:
    """``date`` of public holidays (uk or jersey): fixed days move off weekends and off each other."""
    y = F.col("y")
    first_monday = F.next_day(F.date_sub(_day(y, 5, 1), 1), "Mon")
    last_monday = lambda month: F.next_day(F.date_sub(F.last_day(_day(y, month, 1)), 7), "Mon")
    boxing = _day(y, 12, 26)
    days = [_off_weekend(_day(y, 1, 1)), _off_weekend(_day(y, 12, 25)), F.date_add(boxing, F.when(_weekday(boxing).isin(5, 6), 2).when(_weekday(boxing) == 0, 1).otherwise(0)), F.date_sub(easter(y), 2), F.date_add(easter(y), 1), first_monday, last_monday(5), last_monday(8)]
    if region == "jersey":
        days.append(_off_weekend(_day(y, 5, 9)))
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    once = spark.range(1).select(F.explode(F.array(*[F.lit(d).cast("date") for d in ONE_OFF_HOLIDAYS])).alias("date"))
    return years.select(F.explode(F.array(*days)).alias("date")).unionAll(once).distinct()


def working_calendar(days: DataFrame, off: DataFrame) -> DataFrame:
    """Flags, and ``work_before``: working days before each date. A calendar has one row a day, so one sorted task does."""
    flagged = days.join(F.broadcast(off.select("date").withColumn("_off", F.lit(True))), "date", "left")
    flagged = flagged.withColumn("is_holiday", F.col("_off").isNotNull()).withColumn("is_working_day", ~F.col("is_weekend") & ~F.col("is_holiday")).drop("_off")
    before = F.sum(F.col("is_working_day").cast("int")).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    return flagged.withColumn("work_before", F.coalesce(before, F.lit(0)).cast("long"))


def add_working_days(df: DataFrame, start: str, end: str, calendar: DataFrame, out: str = "working_days") -> DataFrame:
    """Working days in [start, end): two equi joins on the calendar's running count instead of a range join. Ends outside
    the calendar count as its first day and the day after its last."""
    ends = calendar.where("work_before is not null").agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.max(F.struct("date", (F.col("work_before") + F.col("is_working_day").cast("int")).alias("w")))["w"].alias("all")).first()
    counts = F.broadcast(calendar.select(F.col("date").alias("_d"), F.col("work_before").alias("_w")))
    lo, hi = F.lit(ends["lo"]), F.lit(ends["hi"])

    def at(frame: DataFrame, column: str, name: str) -> DataFrame:
        c = F.col(column).cast("date")
        day = F.when(c < lo, lo).when(c <= hi, c)
        joined = frame.join(counts, day == F.col("_d"), "left")
        return joined.withColumn(name, F.when(c > hi, F.lit(ends["all"])).otherwise(F.col("_w"))).drop("_d", "_w")

    both = at(at(df, start, "_from"), end, "_to")
    return both.withColumn(out, F.greatest(F.col("_to") - F.col("_from"), F.lit(0))).drop("_from", "_to")


def expand_days(df: DataFrame, start: str, end: str, out: str = "date", calendar: DataFrame | None = None, count: str | None = None) -> DataFrame:
    """A row for each weekday in [start, end]; with a calendar, for each of its working days. ``count`` names a column for
    how many weekdays the row's interval has; with a calendar there is none."""
    valid = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end).cast("date") >= F.col(start).cast("date")))
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    if calendar is not None:
        return valid.withColumn(out, F.explode(days)).join(F.broadcast(calendar.where("is_working_day").select(F.col("date").alias(out))), out)
    days = F.filter(days, lambda d: F.weekday(d) < 5)
    return (valid.withColumn(count, F.size(days)) if count else valid).withColumn(out, F.explode(days))
