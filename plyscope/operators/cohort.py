"""Cohort comparison: a member's rates against all *other* members of the same cell.

The direct form joins every member row with every other member's rows of the cell and so grows
with (members × cohort). Since "everyone else" is "the whole cell minus me", the same integers come
from two partial/final aggregates — per cell, and per (cell, member) — and a subtraction; no row
pairs are ever built, and a member holding a large share of a cell costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def indicator_counts(df: DataFrame, keys: Sequence[str], indicators: dict[str, Column], total: str) -> DataFrame:
    """COUNT(*) and COUNT_IF(indicator) per key group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total),
                                 *[F.count_if(c).alias(n) for n, c in indicators.items()])


def with_others(per_member: DataFrame, member_col: str, cell: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """``per_member`` (one row per member and cell, counts in ``totals``) with each total replaced by
    that of the cell's *other* members. NULL members never differ from anyone, as with SQL ``<>``, so
    they are neither compared nor counted. The cell totals are rolled up from the member totals."""
    known = per_member.filter(F.col(member_col).isNotNull())
    cells = known.groupBy(*cell).agg(*[F.sum(n).alias(f"__cell_{n}") for n in totals])
    both = known.join(cells, list(cell))
    return both.withColumns({n: F.col(f"__cell_{n}") - F.col(n) for n in totals}).drop(*[f"__cell_{n}" for n in totals])
