"""Tables of which whole days are replaced, in folders of a period each.

``replace`` takes the new rows of some days and writes the folders that hold
them: the folder's other days are copied as they are, and the files of all other
folders keep their names (dynamic partition overwrite). A folder left without
rows goes. The period is a month unless told otherwise: a folder a day is too
fine for small tables, and a table of many rows a day takes ``day``.

Folders are replaced one after the other when the job commits, so a crash in
between leaves some old; running the same step again gives the same days, so
nothing has to be undone. One writer at a time.

Only distinct days come to the driver; their number is bounded by the calendar,
not by the rows. Rows without a day have a folder too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.plans.versions import _FS
from starmart.session import freed_shuffles

FOLDER = "_from"
_NONE = "__HIVE_DEFAULT_PARTITION__"
#: Periods of a folder and the first day of the one a day lies in.
_FIRST = {"day": lambda d: d, "month": lambda d: d.replace(day=1), "year": lambda d: d.replace(month=1, day=1)}


def distinct_days(rows: DataFrame, day: str) -> set[dt.date | None]:
    """The days of some rows (None for rows without one)."""
    return {r[0] for r in rows.select(day).distinct().collect()}


def _among(column: str, dates: Collection[dt.date | None]) -> Column:
    """Is the column one of these dates? Written as text: thousands of literals
    made one by one take seconds."""
    known = ", ".join(f"DATE'{d.isoformat()}'" for d in sorted(d for d in dates if d is not None))
    found = F.expr(f"coalesce(`{column}` IN ({known}), false)") if known else F.lit(False)
    return found | F.col(column).isNull() if None in dates else found


class DayTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str, period: str = "month"):
        """``schema``: the columns, ``day`` (a date) among them."""
        self.spark, self.path, self.schema, self.day, self.period = spark, path.rstrip("/"), schema, day, period
        self._stored = T.StructType([*schema.fields, T.StructField(FOLDER, T.DateType())])
        self._fs = _FS(spark, self.path)

    def _folders(self, days: Collection[dt.date | None]) -> set[dt.date | None]:
        return {None if d is None else _FIRST[self.period](d) for d in days}

    def _scan(self, days: Collection[dt.date | None] | None = None) -> DataFrame:
        """The table, or the whole folders of some days; no other one is opened."""
        if not self._fs.exists(self._fs.path):
            return self.spark.createDataFrame([], self._stored)
        rows = self.spark.read.schema(self._stored).parquet(self.path)
        return rows if days is None else rows.where(_among(FOLDER, self._folders(days)))

    def read(self, days: Collection[dt.date | None] | None = None) -> DataFrame:
        """The table, or the rows of some days."""
        rows = self._scan(days).drop(FOLDER)
        return rows if days is None else rows.where(_among(self.day, days))

    def _first(self) -> Column:
        return F.col(self.day) if self.period == "day" else F.trunc(self.day, self.period)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).withColumn(FOLDER, self._first())

    def _write(self, rows: DataFrame, mode: str, overwrite: str) -> None:
        with freed_shuffles(self.spark):
            (rows.write.mode(mode).option("partitionOverwriteMode", overwrite).option("compression", "zstd")
             .partitionBy(FOLDER).parquet(self.path))

    def append(self, rows: DataFrame) -> None:
        """Add rows of any days; the files there stay."""
        self._write(self._placed(rows).hint("rebalance", FOLDER), "append", "static")

    def replace(self, rows: DataFrame, days: Collection[dt.date | None] | None = None, same: DataFrame | None = None,
                last: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """``rows``, and stored rows ``same`` of these days that stay, take the
        place of the given days' rows (None: of the whole table). ``last`` makes
        the columns that need no shuffle, after the rows have been rebalanced.

        ``rows`` outside the given days are an error of the caller. The write
        rebalances them by folder, so that several tasks write a hot one; what
        is read from the table lies by folders already and isn't shuffled.
        """
        if last is None:
            new = self._placed(rows).hint("rebalance", FOLDER)
        else:
            new = last(rows.withColumn(FOLDER, self._first()).hint("rebalance", FOLDER)).select(*self.schema.names, FOLDER)
        if days is not None:
            if not days:
                return
            new = new.unionByName(self._scan(days).where(~_among(self.day, days)))
            if same is not None:
                new = new.unionByName(self._placed(same))
        before = {} if days is None else {d: self._files(d) for d in self._folders(days)}
        self._write(new, "overwrite", "static" if days is None else "dynamic")
        for d, names in before.items():  # a folder without rows wasn't overwritten: its last rows went
            if names and self._files(d) == names:
                self._fs.fs.delete(self._folder(d), True)

    def _folder(self, first: dt.date | None):
        return self._fs.child(f"{FOLDER}={_NONE if first is None else first.isoformat()}")

    def _files(self, first: dt.date | None) -> list[str]:
        return sorted(self._fs.list_names(self._folder(first)))
