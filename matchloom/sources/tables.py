"""Warehouse tables: whole, one day, or a trailing window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.time import trailing_start


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet where ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def day_range(column: Column, ds: str | dt.date) -> Column:
    """Rows of one date. Half-open bounds on the bare column reach the scan;
    a function of the column wouldn't."""
    day = dt.date.fromisoformat(str(ds))
    return (column >= F.lit(day)) & (column < F.lit(day + dt.timedelta(days=1)))


def one_day(rows: DataFrame, column: str, ds: str | dt.date) -> DataFrame:
    return rows.where(day_range(F.col(column), ds))


def these_days(rows: DataFrame, column: str, days: Sequence[dt.date]) -> DataFrame:
    """Rows of several dates; a partition filter where the column is one."""
    return rows.where(F.col(column).isin(list(days)))


def last_days(
    rows: DataFrame, column: str, as_of: str | dt.date | Column | None = None, days: int = 90
) -> DataFrame:
    """Rows from ``as_of - days`` on; ``as_of`` is today unless given."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(dt.date.fromisoformat(str(as_of)))
    return rows.where(F.col(column) >= trailing_start(as_of, days))
