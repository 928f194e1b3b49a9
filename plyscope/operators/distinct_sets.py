"""Exact distinct sets that merge: bitmaps over numbered members.

A distinct count cannot be added up from the counts of parts. Here each member gets a number once, and a
set is kept as rows (keys, block, bits): one bitmap of 32,768 numbers for each block of numbers that the set
touches. The union of sets is a bitwise OR per block, which combines map-side; its size is exact.

Numbers are given in the order of ``cluster`` columns, so that the members of a cell lie in few blocks. They
come from each range partition's own run, not from a window over all members, and are written before use,
so a recomputed task cannot number its members anew. A row holds 4 KB whatever the block's members are; a set
of n members that lie together has about n / 32,768 rows, and no task gets more than the rows' map-side OR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768


def numbered_members(members: DataFrame, key: str, cluster: Sequence[str], path: str) -> DataFrame:
    """(key, number), one row per distinct non-NULL key, written to ``path`` (a shared folder).

    A key that occurs under several ``cluster`` values is placed by the least of them."""
    place = F.min(F.struct(*cluster)).alias("__place")
    once = members.filter(F.col(key).isNotNull()).groupBy(key).agg(place)
    run = once.repartitionByRange("__place", key).sortWithinPartitions("__place", key)
    run.select(key, (F.monotonically_increasing_id() + 1).alias("number")).write.mode("overwrite").parquet(path)
    return members.sparkSession.read.schema(f"{key} {once.schema[key].dataType.simpleString()}, number bigint").parquet(path)


def member_sets(df: DataFrame, keys: Sequence[str], number: str, sets: dict[str, Column]) -> DataFrame:
    """Per key group and block of numbers, a bitmap for each named condition: the numbers of the rows
    where it holds. Rows without a number are left out."""
    known = df.filter(F.col(number).isNotNull())
    bit = F.bitmap_bit_position(F.col(number))
    return known.groupBy(*keys, F.bitmap_bucket_number(F.col(number)).alias("block")).agg(
        *[F.bitmap_construct_agg(F.when(cond, bit)).alias(name) for name, cond in sets.items()])


def union_sizes(sets: DataFrame, keys: Sequence[str], counts: dict[str, str]) -> DataFrame:
    """Per key group, the sizes of the unions of its bitmaps; ``counts`` maps result names to bitmap columns."""
    blocks = sets.groupBy(*keys, "block").agg(*[F.bitmap_or_agg(c).alias(out) for out, c in counts.items()])
    return blocks.groupBy(*keys).agg(*[F.sum(F.bitmap_count(out)).alias(out) for out in counts])
