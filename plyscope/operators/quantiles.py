"""Mergeable quantile sketch of integers with a stated relative error.

Numbers are counted in buckets: those of at most ``bits`` binary digits have a bucket each, longer ones
share it with all numbers that have the same sign, length and first ``bits`` digits. A bucket is named by
its number nearest to zero and stands for its middle, which differs from each of its numbers by at most
that number's size / 2**bits. Buckets keep the order of the numbers, so a quantile of the sketch is the
middle of the bucket that holds the exact (nearest-rank) quantile.

A sketch is an array of (bucket, n), ordered by bucket. Merging adds counts, so it loses nothing: merged
sketches equal the sketch of all rows, in any order and grouping. It holds at most
2**bits * (65 - bits) entries however many rows it stands for, so it may be gathered per group; rows are
counted map-side first, and a group with a third of all rows costs each task no more than its buckets.

NULL numbers are not counted; a group without numbers has an empty sketch, whose quantiles are NULL. The
least 64-bit number is counted with its successor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = "array<struct<bucket:bigint,n:bigint>>"


def _spare(size: Column, bits: int) -> Column:
    """Binary digits of a non-negative number beyond its first ``bits``."""
    return F.greatest(F.length(F.bin(size)) - F.lit(bits), F.lit(0))


def _signed(size: Column, like: Column) -> Column:
    return F.when(like < 0, -size).otherwise(size)


def bucket_of(value: Column, bits: int) -> Column:
    """The number nearest to zero of the bucket that ``value`` falls into."""
    value = value.cast("bigint")
    size = F.abs(F.when(value.isNotNull(), F.greatest(value, F.lit(1 - (1 << 63)))))
    spare = _spare(size, bits)
    low = F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)
    return _signed(low, value)


def middle_of(bucket: Column, bits: int) -> Column:
    """The number that a bucket stands for."""
    size = F.abs(bucket)
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), _spare(size, bits))
    return _signed(size + F.shiftright(width, 1), bucket)


def gathered(counted: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """One sketch per key group of rows (keys, bucket, n), one for each bucket; a NULL bucket is none."""
    entry = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "n"))
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(out))


def sketches(df: DataFrame, keys: Sequence[str], value: Column, bits: int, out: str = "sketch") -> DataFrame:
    """One row per key group: keys and the sketch of ``value``."""
    counted = df.groupBy(*keys, bucket_of(value, bits).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return gathered(counted, keys, out)


def merged(df: DataFrame, keys: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """One row per key group: keys and the group's sketches (of the same ``bits``) in one."""
    entries = df.select(*keys, F.explode_outer(sketch).alias("__e")).select(*keys, "__e.bucket", "__e.n")
    return gathered(entries.groupBy(*keys, "bucket").agg(F.sum("n").alias("n")), keys, sketch)


def total(sketch: Column) -> Column:
    """How many numbers a sketch stands for."""
    return F.aggregate(sketch, F.lit(0).cast("bigint"), lambda seen, e: seen + e["n"])


def quantile(sketch: Column, q: float, bits: int) -> Column:
    """The nearest-rank quantile (0 < q <= 1) of a sketch, within size / 2**bits of the exact one."""
    rank = F.ceil(F.lit(float(q)) * total(sketch))
    state = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at"))

    def step(acc: Column, e: Column) -> Column:
        seen = acc["seen"] + e["n"]
        return F.struct(seen.alias("seen"), F.coalesce(acc["at"], F.when(seen >= rank, e["bucket"])).alias("at"))
    return F.aggregate(sketch, state, step, lambda acc: middle_of(acc["at"], bits))
