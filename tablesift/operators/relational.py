"""Everyday relational operations (maps, filters, membership, top-k,
per-group top record, counters, dates and nulls, text rendering).

Each one is a column expression or a built-in aggregate, so Catalyst can
push filters and prune columns through it and whole-stage codegen covers it;
the per-row lambdas of a typed API become expressions here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def linear_map(c: Column, factor: float = 2, offset: float = 0.5) -> Column:
    """``x * factor + offset`` as a double."""
    return (c * F.lit(factor) + F.lit(offset)).cast("double")


def prefixed_text(c: Column, prefix: str) -> Column:
    """``prefix`` followed by the value's text form."""
    return F.concat(F.lit(prefix), c.cast("string"))


def literal_columns(*values) -> list[Column]:
    """Constant columns, one per value (a row-to-tuple map with literals)."""
    return [F.lit(v) for v in values]


def text_and_int(c: Column) -> tuple[Column, Column]:
    """The value as text, and that text parsed back to int (null when it is
    not an integer)."""
    text = c.cast("string")
    return text, text.try_cast("int")


def filter_members(df: DataFrame, c: str, values, negate: bool = False) -> DataFrame:
    """Keep rows whose ``c`` is in ``values`` (or not, with ``negate``).

    ``values`` is a short Python list (becomes ``isin``; Spark ships it with
    the plan) or a one-column DataFrame (becomes a semi / anti join;
    Spark broadcasts the list if its size in bytes, measured at run time, is
    below ``spark.sql.autoBroadcastJoinThreshold``).  As with a list lookup, a null
    ``c`` is never a member, so ``negate`` keeps null rows.
    """
    if isinstance(values, DataFrame):
        key = values.columns[0]
        right = values.select(F.col(key).alias("__member")).where(F.col("__member").isNotNull()).distinct()
        how = "left_anti" if negate else "left_semi"
        return df.join(right, F.col(c) == F.col("__member"), how)
    cond = F.col(c).isin(list(values))
    if negate:
        return df.where(F.col(c).isNull() | ~cond)
    return df.where(cond)


def filter_equals(df: DataFrame, c: str, value) -> DataFrame:
    return df.where(F.col(c) == F.lit(value))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (planned as TakeOrderedAndProject: each
    task keeps its own top k, the driver merges k per task)."""
    return df.orderBy(*order).limit(k)


def group_top(df: DataFrame, group: str, value: str, payload: list[str], tie: str) -> DataFrame:
    """Per group, the row with the largest ``value`` (ties: smallest ``tie``).

    ``max_by`` over a struct key is a partially aggregated hash aggregate, so
    a group holding a third of all rows still reduces map-side to one row
    per task; nothing is collected per group.
    """
    key = F.struct(F.col(value), (-F.col(tie)).alias("tie"))
    best = F.max_by(F.struct(*[F.col(p) for p in payload + [value]]), key)
    return df.groupBy(group).agg(best.alias("best")).select(group, *[F.col(f"best.{p}").alias(p) for p in payload + [value]])


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One pass, one row: ``count_if`` per named condition (replaces a set
    of counters incremented in a ``foreach``)."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def observe_counts(df: DataFrame, conditions: dict[str, Column], name: str = "counters"):
    """Attach the counters to ``df`` as side metrics: returns the observed
    frame and an ``Observation`` whose ``.get`` is filled once an action
    has run on that frame (the side-effect-free form of accumulators)."""
    obs = Observation(name)
    observed = df.observe(obs, *[F.count_if(cond).alias(n) for n, cond in conditions.items()])
    return observed, obs


def fill_and_flag_nulls(df: DataFrame, fill: str, subset: list[str]) -> DataFrame:
    """``na.fill`` on the listed columns; only string columns change (date
    and timestamp columns in the list are left as they are)."""
    return df.na.fill(fill, subset)


def parse_filter(c: Column, threshold: int) -> Column:
    """Parse text to int and compare; text that is no number is dropped."""
    return c.cast("string").try_cast("int") > F.lit(threshold)
