"""Ordered scans over sequences of any length: segmented prefix scans.

A window puts a whole partition into one task. Where one key holds a large share of all rows, the
sorted rows are cut into segments instead, by range, so that a key's sequence may run through many segments:

1. ``cut_segments``: the rows are range-partitioned by key and order and landed with the number of their
   segment, which fixes the cuts (a task that is run again reads them, it does not cut anew);
2. ``segmented_scan``: within each (segment, key) plain window functions give the local answers;
3. each (segment, key) leaves one border row: its last value for a lag, its first one for a first value. A
   window over a key's border rows, one per segment, gives what each segment carries in;
4. the carries of keys that run through several segments (at most two such keys begin or end in a
   segment, so there are at most two carries per segment) are joined to the segments and applied.

Step 2 to 4 may be repeated on the same cut, for scans over columns derived from earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyscope.session import landed

SEGMENT = "__segment"


@dataclass(frozen=True)
class Lag:
    """``out``: the value on the row before."""

    out: str
    value: Column


@dataclass(frozen=True)
class First:
    """``out``: the value on the sequence's first row where ``where`` holds, be it NULL (M12's divisor), or the
    first non-NULL value if ``skip_nulls`` (M25); the same on every row of the sequence."""

    out: str
    value: Column
    where: Column | None = None
    skip_nulls: bool = False


def cut_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], segments: int | None = None) -> DataFrame:
    """``df`` landed in ``segments`` ranges of (keys, order), by default as many as shuffle partitions, with
    the range's number. Rows equal in both lie in one range."""
    spark = df.sparkSession
    parts = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    return landed(df.repartitionByRange(parts, *by).withColumn(SEGMENT, F.spark_partition_id()), "segments")


def segmented_scan(cut: DataFrame, keys: Sequence[str], order: Sequence[str], scans: Sequence[Lag | First]) -> DataFrame:
    """``cut`` with one column per scan, as windows over ``keys`` ordered by ``order`` (NULLs first) would
    give. ``order`` should be total but for rows whose scanned values are equal. A NULL key is a key."""
    place = F.struct(*order)
    spec = Window.partitionBy(SEGMENT, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local, border, carry = {}, {}, {}
    of_key = Window.partitionBy(*keys).orderBy(SEGMENT)     # a row for each segment of the key
    every = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for i, s in enumerate(scans):
        # a NULL that was found differs from nothing found: values travel in one-field structs
        boxed = F.struct(s.value.alias("v"))
        if isinstance(s, Lag):
            local[f"__l{i}"], border[f"__b{i}"] = F.lag(boxed).over(spec), F.max_by(boxed, place)
            carry[f"__c{i}"] = F.lag(f"__b{i}").over(of_key)
            continue
        for held in (s.where, s.value.isNotNull() if s.skip_nulls else None):
            boxed = boxed if held is None else F.when(held, boxed)
        local[f"__l{i}"] = F.first(boxed, ignorenulls=True).over(whole)
        border[f"__b{i}"] = F.min_by(boxed, F.when(boxed.isNotNull(), place))
        carry[f"__c{i}"] = F.first(f"__b{i}", ignorenulls=True).over(every)
    borders = cut.groupBy(SEGMENT, *keys).agg(*[c.alias(n) for n, c in border.items()])
    carries = borders.withColumns(carry | {"__n": F.count(F.lit(1)).over(every)}).filter(F.col("__n") > 1).select(
        F.col(SEGMENT).alias("__s"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *carry)
    same = F.col(SEGMENT) == F.col("__s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = cut.withColumns(local).join(carries, same, "left")
    return out.withColumns({
        s.out: (F.coalesce(f"__l{i}", f"__c{i}") if isinstance(s, Lag) else F.coalesce(f"__c{i}", f"__l{i}"))["v"]
        for i, s in enumerate(scans)}).select(*cut.columns, *[s.out for s in scans])
