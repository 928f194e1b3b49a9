"""Ordered-sequence operators over (entity, step) tables: swings, lags, ratios, first occurrences.

All of them are window expressions over small partitions (one game); keep their partition keys
compatible (same leading key) so a single hash partitioning on that key serves every window
without another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _window(partition: Sequence[str], order):
    """Window over ``partition`` ordered by ``order`` (a step column, or step then tie-breakers)."""
    return Window.partitionBy(*partition).orderBy(*[F.col(c).asc() for c in _order_cols(order)])


def ratio_to_first(df: DataFrame, value: str, partition: Sequence[str], order: str, out: str) -> DataFrame:
    """Value ÷ the value on the first step of the partition (NULL-respecting; ÷0 → NULL)."""
    first = F.first(F.col(value)).over(_window(partition, order))
    return df.withColumn(out, F.try_divide(F.col(value), first))


def ratio_to_first_of_group(df: DataFrame, value: str, group_col: str, groups: Sequence[str],
                            partition: Sequence[str], order: str, out: str) -> DataFrame:
    """M12 on a shared window: value ÷ the value on the first step of the row's group (e.g. colour)
    inside the partition; NULL-respecting like FIRST_VALUE, ÷0 → NULL.

    ``min_by(value, step-of-that-group)`` over the whole partition gives the first value of each
    group in one pass, so no separate (entity, group) window and exchange are needed.
    """
    w = _window(partition, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    g, step = F.col(group_col), F.col(_order_cols(order)[0])
    first = None
    for name in groups:
        v = F.min_by(F.col(value), F.when(g == F.lit(name), step)).over(w)
        first = F.when(g == F.lit(name), v) if first is None else first.when(g == F.lit(name), v)
    return df.withColumn(out, F.try_divide(F.col(value), first))


def score_swing(df: DataFrame, score: str, partition: Sequence[str], order: str,
                prev_out: str, delta_out: str) -> DataFrame:
    """Previous score and the change since it, per partition in step order."""
    prev = F.lag(F.col(score)).over(_window(partition, order))
    return df.withColumn(prev_out, prev).withColumn(delta_out, F.col(score) - F.col(prev_out))


def lag_of(df: DataFrame, col: str, partition: Sequence[str], order: str, out: str) -> DataFrame:
    """The value of ``col`` on the previous step."""
    return df.withColumn(out, F.lag(F.col(col)).over(_window(partition, order)))


def first_non_null_over(df: DataFrame, expr: Column, partition: Sequence[str], order: str, out: str) -> DataFrame:
    """First non-NULL value of ``expr`` in step order, repeated on every row of the partition."""
    w = _window(partition, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(out, F.first(expr, ignorenulls=True).over(w))
