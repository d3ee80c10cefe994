"""Exploration and profiling: group counts, HAVING, top-k, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys: Sequence[str], alias: str = "count") -> DataFrame:
    """Rows per group, nulls included (A1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def count_of(df: DataFrame, key: str, alias: str = "qty") -> DataFrame:
    """Non-null values of ``key`` per group of ``key`` (A2); a null key counts 0."""
    return df.groupBy(key).agg(F.count(F.col(key)).alias(alias))


def global_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """One-row DataFrame with the row count (A3)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def having(df: DataFrame, condition: Column) -> DataFrame:
    """Filter after aggregation."""
    return df.where(condition)


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "qty") -> DataFrame:
    """Keys seen more than once (Q2); empty result = unique."""
    return having(group_count(df, keys, alias), F.col(alias) > 1)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (O2); plans as TakeOrderedAndProject:
    each task keeps its own top k, only k rows per task are merged."""
    return df.orderBy(*order).limit(k)


def missing(df: DataFrame, present: Sequence[str] = (), absent: Sequence[str] = (),
            any_absent: Sequence[str] = ()) -> DataFrame:
    """Rows where all ``present`` are set and all ``absent`` are null, or any
    of ``any_absent`` is null (F2, Q3)."""
    cond = F.lit(True)
    for c in present:
        cond = cond & F.col(c).isNotNull()
    for c in absent:
        cond = cond & F.col(c).isNull()
    if any_absent:
        anyc = F.lit(False)
        for c in any_absent:
            anyc = anyc | F.col(c).isNull()
        cond = cond & anyc
    return df.where(cond)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: per column the number of nulls (Q3 as one aggregate)."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls") for c in cols])
