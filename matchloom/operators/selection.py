"""Choosing players, matches, rows and columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from matchloom import domain
from matchloom.functions.time import within_day


def first_players(players: DataFrame, rank: str | Sequence[str] = "puuid", limit: int | None = None) -> DataFrame:
    """The first ``limit`` players by an explicit rank, such as their place in a list; all of them without a limit."""
    return players if limit is None else players.orderBy(rank).limit(limit)


def recent_match_ids(
    player_matches: DataFrame,
    count: int | None = None,
    ds: str | None = None,
    player: str = "puuid",
    match: str = "matchId",
    start: str = "startTs",
) -> DataFrame:
    """Distinct ids of each player's latest ``count`` matches, all without one, on one day if given.

    Ranks are taken twice: within a player's rows of one salt, and then among the survivors. A player
    with a large part of all rows is so ranked by ``SALTS`` tasks, each of which lets through at most
    ``count`` rows. The first rank filter runs before the shuffle too.
    """
    if ds is not None:
        player_matches = player_matches.where(
            within_day(F.col(start), F.lit(ds).cast("date"))
        )
    if count is None:
        return player_matches.select(match).distinct()
    listed = player_matches.groupBy(player, match).agg(F.max(start).alias(start))
    return top_n(listed, [player], [F.desc(start), F.asc(match)], count, F.xxhash64(match)).select(match).distinct()


#: Parts that the rows of a key are ranked in first.
SALTS = 64


def top_n(
    rows: DataFrame, by: Sequence[str], order: Sequence[Column], count: int, spread: Column, salts: int | None = None
) -> DataFrame:
    """The first ``count`` rows per key, ranked within salts and then over what is left of them.

    ``spread`` is a whole number that deals a key's rows evenly. No task ranks more than a key's rows by
    the number of salts, or ``count`` rows of each of them.
    """
    salted = rows.withColumn("_salt", F.pmod(spread, F.lit(salts or SALTS)))
    inner, outer = Window.partitionBy(*by, "_salt").orderBy(*order), Window.partitionBy(*by).orderBy(*order)
    survivors = salted.withColumn("_rank", F.row_number().over(inner)).where(F.col("_rank") <= count).drop("_rank", "_salt")
    return survivors.withColumn("_rank", F.row_number().over(outer)).where(F.col("_rank") <= count).drop("_rank")


def load_counts(asked: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """How many ids were asked for and how many of them landed, as one row."""
    there = landed.select(key).distinct().withColumn("_landed", F.lit(True))
    return asked.select(key).distinct().join(there, key, "left").agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("_landed")).alias("succeeded")
    )


def upper_columns(rows: DataFrame) -> DataFrame:
    return rows.toDF(*[c.upper() for c in rows.columns])


def columns_like(rows: DataFrame, part: str = "_DIF") -> list[str]:
    """Columns whose name contains ``part`` anywhere."""
    return [c for c in rows.columns if part in c]


def columns_except(rows: DataFrame, excluded: Sequence[str] = domain.NOT_FEATURES) -> list[str]:
    return [c for c in rows.columns if c not in excluded]


def present(rows: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of the names that are columns, in the given order."""
    return [n for n in names if n in rows.columns]


def require_features(names: Sequence[str]) -> Sequence[str]:
    if not names:
        raise ValueError("no feature columns found")
    return names


def drop_incomplete(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null and no NaN in any column.

    Written as one test per column, not as ``na.drop``: Catalyst turns these
    into scan filters and an outer join below them into an inner one.
    """
    return rows.where(complete_row(rows, columns))


def completeness(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows training uses and how many it leaves out; scoring uses them all."""
    complete = complete_row(rows, columns)
    return rows.agg(
        F.count_if(complete).alias("complete"), F.count_if(~complete).alias("incomplete")
    )


def complete_row(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    wanted = rows.columns if columns is None else columns
    return reduce(lambda a, b: a & b, [complete_value(rows, name) for name in wanted])


def complete_value(rows: DataFrame, name: str) -> Column:
    there = F.col(name).isNotNull()
    if isinstance(rows.schema[name].dataType, (DoubleType, FloatType)):
        there = there & ~F.isnan(name)
    return there


def position_label(
    position: Column, labels: Mapping[str, str] = domain.POSITION_LABELS
) -> Column:
    """Value of the label column that belongs to the row's position, in any case."""
    upper = F.upper(position)
    first, *others = labels.items()
    chosen = F.when(upper == first[0], F.col(first[1]))
    for name, label in others:
        chosen = chosen.when(upper == name, F.col(label))
    return chosen


def stable_split(
    rows: DataFrame,
    keys: Sequence[str],
    test_percent: int = 20,
    seed: int = 29,
    bucket: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the keys, so that neither partitioning nor a
    rerun moves a row. ``bucket`` replaces the hash with another 0..99 column."""
    part = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(100)) if bucket is None else bucket
    return rows.where(part >= test_percent), rows.where(part < test_percent)


#: Bits of a hash that one round of ``least_by_hash`` looks at, and rows that it no longer narrows down.
ROUND_BITS, FEW = 12, 10_000


def least_by_hash(rows: DataFrame, number: Column, count: int, bits: int = 63) -> tuple[Column, int]:
    """A condition for the rows with the ``count`` least numbers, and how many rows meet it.

    ``number`` is a whole number from 0 below ``2 ** bits``. Each round counts the rows by the next bits of it and
    goes on inside the bin that the ``count``-th row is in, so a round returns 2^12 counts and nothing is
    sorted. Rows of one number stay together: the condition may hold for more than ``count`` rows then.
    """
    low, left, below = 0, bits, 0
    while left > 0:
        step = min(ROUND_BITS, left)
        bin_ = F.shiftright(number - F.lit(low), left - step)
        inside = rows.where((number >= F.lit(low)) & (number < F.lit(low + (1 << left)) if left < 63 else number >= F.lit(low)))
        counted = sorted((r[0], r[1]) for r in inside.groupBy(bin_.alias("b")).count().collect())  # at most 2^12 rows
        for b, n in counted:
            if below + n >= count:
                break
            below += n
        else:
            return number >= F.lit(0), below
        low, left = low + (b << (left - step)), left - step
    return number <= F.lit(low), below + n


def exact_split(
    rows: DataFrame, keys: Sequence[str], test_percent: int = 20, seed: int = 29, number: Column | None = None, bits: int = 63
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, the test part exactly the given percent of the rows, rounded up.

    Test rows are those with the least hashes of the keys, found without a sort, so neither partitioning nor a
    rerun moves a row. Rows of one key are one row to a split, and go to one side: a test part that ends within
    them has all of them. ``number`` replaces the hash with another whole number below ``2 ** bits``. The rows are read
    several times.
    """
    if number is None:
        number = F.xxhash64(*keys, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))
    whole = rows.count()
    wanted = -(-whole * test_percent // 100)
    if not wanted:
        return rows, rows.where(F.lit(False))
    least, _ = least_by_hash(rows, number, wanted, bits)
    return rows.where(~least), rows.where(least)
