"""Count helpers; broadcasts are left to the optimizer, which knows the sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_over(df: DataFrame, keys: Sequence[str], out: str, keyed: DataFrame | None = None) -> DataFrame:
    """Rows per key group attached to every row (like ``COUNT(*) OVER (PARTITION BY keys)``).

    Written as a partial/final aggregate joined back on null-safe keys instead of a window: a
    window would move a whole group into one task, while the aggregate combines map-side and the
    join back is split by AQE's skew handling when one group holds a large share of the rows.
    ``keyed`` may give the same rows from a cheaper plan (only the keys are needed to count).
    """
    counts = (keyed if keyed is not None else df).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    renamed = counts.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], out)
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(renamed[f"__k_{i}"])
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, "left").drop(*[f"__k_{i}" for i in range(len(keys))])


def grid_join(left: DataFrame, right: DataFrame, parts: int | None = None) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, for two sides that share one key value: the rows of one
    side are dealt over the rows of a grid, the other's over its columns, and each cell is a join key
    of its own. All cells get the same share of the pairs, whatever the sides hold."""
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = max(1, round(parts ** 0.5))
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    dealt = (F.monotonically_increasing_id() % side).cast("int")
    a = left.withColumn("__row", dealt).withColumn("__column", every)
    b = right.withColumn("__column", dealt).withColumn("__row", every)
    return a.join(b, ["__row", "__column"]).drop("__row", "__column")
