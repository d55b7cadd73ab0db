"""Shares of a total, ordering and bounded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pct_of_total(counts: DataFrame, count_col: str, out: str = "pct") -> DataFrame:
    """Adds each row's share of the grand total, in percent.

    The total is a scalar subquery over partial sums. A window without keys
    would send every row through one task. Spark reuses the shuffle of
    ``counts`` for the subquery.
    """
    total = counts.agg(F.sum(F.col(count_col).cast("double"))).scalar()
    share = F.col(count_col).cast("double") * 100 / F.nullif(total, F.lit(0.0))
    return counts.withColumn(out, F.round(share, 2))


def pct_of_group(
    counts: DataFrame, count_col: str, group_cols: Sequence[str], out: str = "pct"
) -> DataFrame:
    """Adds each row's share of its group's total, in percent.

    ``counts`` holds one row per group and label, so a window partition is as
    small as the number of labels in a group.
    """
    whole = F.sum(F.col(count_col).cast("double")).over(Window.partitionBy(*group_cols))
    share = F.col(count_col).cast("double") * 100 / F.nullif(whole, F.lit(0.0))
    return counts.withColumn(out, F.round(share, 2))


def order_single(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Largest ``measure`` first; ``ties`` make equal rows come in one order."""
    return df.orderBy(F.desc(measure), *ties)


def order_multi(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.orderBy(*keys)


def sample_limit(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``keys``: a sample that repeats, taken without a full sort."""
    return df.orderBy(*keys).limit(n)
