"""Entry times, the as-of day and the paths derived from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.fixed_values import ENTRY_TIME_FORMAT


def entry_time(updated: Column) -> Column:
    """The UTC wall clock of an entry time as text, or null if it is not a time.

    A bare time of day is refused: the cast would silently put it on the current day.
    """
    text = F.trim(updated)
    dated = F.rlike(text, F.lit(r"^\d{4}"))
    return F.when(dated, F.date_format(F.try_to_timestamp(text), ENTRY_TIME_FORMAT))


def as_of_day(today: Column | None = None) -> Column:
    """The day before ``today`` (default: the current date)."""
    return F.date_sub(F.current_date() if today is None else today, 1)


def compact_day(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def input_prefix(root: str, day: Column) -> Column:
    """Folder of the raw files of a day."""
    return F.concat(F.lit(root.rstrip("/") + "/"), compact_day(day), F.lit("/"))


def partition_path(day: Column) -> Column:
    """``y=2019/m=2/d=20190228``: the month is not padded, the day is the whole compact date."""
    return F.concat(
        F.lit("y="), F.year(day).cast("string"),
        F.lit("/m="), F.month(day).cast("string"),
        F.lit("/d="), compact_day(day),
    )


def partition_columns(day: Column) -> dict[str, Column]:
    """The three partition values as the integers they are read back as."""
    return {"y": F.year(day), "m": F.month(day), "d": compact_day(day).cast("int")}
