"""From feature contributions to role shares. All row work; only the means aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import domain
from matchloom.functions.numeric import ratio, rounded_ratio


def role_of(feature: Column) -> Column:
    """Role of a feature name by keyword; null when none occurs. The rules are few and
    fixed, so they are one CASE and not a join."""
    name = F.upper(feature)
    chosen = None
    for role, keywords in domain.ROLE_KEYWORDS:
        hit = reduce(lambda a, b: a | b, [name.contains(k) for k in keywords])
        chosen = F.when(hit, role) if chosen is None else chosen.when(hit, role)
    return chosen


def role_of_name(name: str) -> str | None:
    """The same for a name that is known when the plan is made."""
    upper = name.upper()
    return next((role for role, words in domain.ROLE_KEYWORDS if any(w in upper for w in words)), None)


def abs_sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.abs(c) for c in columns])


def long_roles(rows: DataFrame, keep: Sequence[str], shares: Mapping[str, Column], name: str):
    """One row per role; the shares of a row are computed before it is multiplied."""
    pairs = F.array(
        *[F.struct(F.lit(role).alias("ROLE"), share.alias(name)) for role, share in shares.items()]
    )
    return rows.select(*keep, F.explode(pairs).alias("_role")).select(*keep, "_role.*")


def role_contribution(
    rows: DataFrame,
    contributions: Mapping[str, Column],
    keep: Sequence[str] = ("DS", "MATCHID"),
) -> DataFrame:
    """Percent of a row's absolute contributions per role, over **all** features.

    A row whose contributions are all 0 gives each role an equal part; a role
    without a feature gets 0; features of no role count in the total only.
    """
    return shares_over_all(
        rows,
        contributions,
        keep,
        "CONTRIB_PCT",
        lambda part, total: F.round(ratio(part * 100.0, total), 2),
        100.0 / len(domain.ROLES),
        "double",
    )


def role_basis_points(
    rows: DataFrame,
    contributions: Mapping[str, Column],
    keep: Sequence[str] = ("DS", "MATCHID"),
) -> DataFrame:
    """``role_contribution`` for whole-number contributions, in hundredths of a percent
    and rounded in integers."""
    return shares_over_all(
        rows,
        contributions,
        keep,
        "CONTRIB_BP",
        lambda part, total: rounded_ratio(part, total, 10_000),
        10_000 // len(domain.ROLES),
        "long",
    )


def shares_over_all(rows, contributions, keep, name, share, equal, kind) -> DataFrame:
    def part_of(role: str) -> Column:
        parts = [F.abs(value) for name, value in contributions.items() if role_of_name(name) == role]
        return reduce(lambda a, b: a + b, parts, F.lit(0).cast(kind))

    summed = rows.select(
        *keep,
        abs_sum(list(contributions.values())).alias("_total"),
        *[part_of(role).alias(f"_{role}") for role in domain.ROLES],
    )
    total = F.col("_total")
    empty = F.lit(equal).cast(kind)

    def of(role: str) -> Column:
        return F.when(total == 0, empty).otherwise(share(F.col(f"_{role}"), total))

    return long_roles(summed, keep, {role: of(role) for role in domain.ROLES}, name)


def role_share_listed(
    rows: DataFrame,
    contributions: Mapping[str, Column],
    listed: Mapping[str, Sequence[str]] = domain.LISTED_FEATURES,
) -> DataFrame:
    """Mean percent per role over the **listed** features only, largest first.

    Each row is scaled to its own sum; a row that sums to 0 counts 0 for every
    role. Names that aren't there are left out, and so is a role with none.
    """
    groups = {role: [f for f in names if f in contributions] for role, names in listed.items()}
    groups = {role: names for role, names in groups.items() if names}
    summed = rows.select(
        *[abs_sum([contributions[f] for f in names]).alias(role) for role, names in groups.items()]
    )
    total = reduce(lambda a, b: a + b, [F.col(role) for role in groups])
    means = summed.withColumn("_total", total).agg(
        *[F.avg(ratio(F.col(role), F.col("_total"))).alias(role) for role in groups]
    )
    return long_roles(
        means, [], {role: F.round(F.col(role) * 100, 2) for role in groups}, "MEAN_PCT"
    ).orderBy(F.desc("MEAN_PCT"), "ROLE")


def role_daily_mean(contributions: DataFrame, value: str = "CONTRIB_PCT") -> DataFrame:
    """Mean of the (already rounded) shares per role, largest first."""
    return (
        contributions.groupBy("ROLE")
        .agg(F.round(F.avg(value), 2).alias("MEAN_PCT"))
        .orderBy(F.desc("MEAN_PCT"), "ROLE")
    )
