"""Sums, shares and rounding."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(columns: Sequence[Column], missing: str = "zero") -> Column:
    """Sum across columns. ``missing="null"``: null as soon as one part is null;
    ``missing="zero"``: a null part counts 0."""
    if missing not in ("zero", "null"):
        raise ValueError(f"missing must be 'zero' or 'null', not {missing!r}")
    if missing == "zero":
        columns = [F.coalesce(c, F.lit(0)) for c in columns]
    return reduce(operator.add, columns)


def ratio(part: Column, total: Column, when_zero: float | None = 0.0) -> Column:
    """``part / total`` as double; a total of zero gives ``when_zero``."""
    share = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return share if when_zero is None else F.coalesce(share, F.lit(when_zero))


def rounded_ratio(part: Column, total: Column, scale: int) -> Column:
    """``scale * part / total`` rounded half up, for non-negative integers only.

    Decided in integers, so no engine can round a tie another way.
    """
    return F.call_function("div", 2 * scale * part + total, 2 * total)


def cents(amount: Column) -> Column:
    """Money as an integer, so that no order of addition can change a sum."""
    return F.rint(amount * 100).cast("long")
