"""Dimensional analytics on Spark: landing, cleansing, keyed dimensions and facts, calendars, hierarchies, periods, metrics."""
