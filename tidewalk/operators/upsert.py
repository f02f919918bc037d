"""How a day's rows meet the rows of days before: append, overwrite whole dates, or refuse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def touched_dates(frames: list[DataFrame | None], date: str) -> DataFrame:
    """The run's date and every date in its rows: what an overwrite rewrites in all tables."""
    spark = next((f.sparkSession for f in frames if f is not None), None)
    if spark is None:
        raise ValueError("no table at all")
    own = spark.createDataFrame([(date,)], "date string")
    return reduce(DataFrame.union, [own, *(f.select("date") for f in frames if f is not None)]).distinct()


def date_conflicts(tables: list[DataFrame], dates: DataFrame) -> DataFrame:
    """Dates that the tables already have."""
    return reduce(DataFrame.union, [t.select("date") for t in tables]).intersect(dates)


def appended(old: DataFrame, new: DataFrame | None) -> DataFrame:
    """Old rows and new ones, repeated dates and all."""
    return old if new is None else old.unionByName(new)


def overwritten(old: DataFrame, new: DataFrame | None, dates: DataFrame) -> DataFrame:
    """The dates' old rows go, new ones come; without new rows the dates are only cleared. Rows without a date stay.

    The dates of one run are few: their number is what the run's own rows have.
    """
    kept = old.join(F.broadcast(dates), "date", "left_anti").select(old.columns)
    return kept if new is None else kept.unionByName(new)


def report_order(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sorted as reports are: by the keys, rows without them first."""
    return frame.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
