"""Co-bucketed staging: tables that join on the game key, and on more keys beside it, without a shuffle.

All tables of a stage are bucketed by ``game_uuid`` into the same number of buckets and sorted by it, with one file
per bucket. A session from ``co_located`` accepts that partitioning for joins and windows on further
keys as well (``game_uuid``, player and ply), since rows that agree on all of them lie in one bucket.
Keyless games are one key and so would be one bucket: they do not belong in such a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.session import apply_required_conf

KEY = "game_uuid"


def stage_by_game(tables: dict[str, DataFrame], path: str, prefix: str, buckets: int,
                  derive: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> dict[str, str]:
    """Write the keyed rows of each table under ``path`` as catalog table ``prefix_name``; returns those names.

    ``derive`` names tables that are made from the given rows, row by row, once these lie in their buckets (columns and
    rows that follow from others need not be shuffled); it keeps the game key."""
    names = {}
    for name, df in tables.items():
        names[name] = f"{prefix}_{name}"
        # dealt as the buckets are, so that each bucket is written by one task
        dealt = df.filter(F.col(KEY) != "").repartition(buckets, KEY)
        dealt = derive[name](dealt) if derive and name in derive else dealt
        (dealt.write.bucketBy(buckets, KEY).sortBy(KEY)
         .option("path", f"{path}/{name}").mode("overwrite").saveAsTable(names[name]))
    return names


def co_located(spark: SparkSession) -> SparkSession:
    """A session over the same catalog in which a join may use its sides' partitioning by a part of its keys.
    The setting is not for joins in general, where it would gather skewed rows, so it has a session of its own."""
    own = spark.newSession()
    apply_required_conf(own)
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.autoBroadcastJoinThreshold"):
        own.conf.set(k, spark.conf.get(k))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own
