"""Two-pass external shuffle into shards (operator 7).

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash of the record (its
id, its text's checksum and its number in the input, so copies of one record spread as well). Pass 2
loads each bucket, orders it by content, shuffles it by Fisher-Yates with a generator seeded by the
bucket, and writes it. The buckets one after another are the shuffled corpus; shards are equal ranges
of it (law ``rows``: counts differ by one at most).

The number of buckets follows the total size, so a bucket holds about ``BUCKET_BYTES``, at any scale
and for any distribution of ids. Only the number of rows of each bucket is summed up in one place.

Results: null text: no bytes (size 16, checksum of the empty text). Null ids and repeated rows are
records like others. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plyscope.llm.common import checkpoint_dir, prepare, written

SHARDS = 40
BUCKET_BYTES = 24 << 20
SEED = 20_011_104
OVERHEAD = 16


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation: from the last place down, swap with a place drawn up to it."""
    order = list(range(n))
    if n > 1:
        draws = rng.integers(0, np.arange(n, 1, -1))
        for i, j in zip(range(n - 1, 0, -1), draws.tolist()):
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _shuffle_bucket(seed: int):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        tab = pa.Table.from_batches(held)
        del held
        bucket = tab.column("__bucket")[0].as_py()
        tab = tab.take(pa.array(fisher_yates(tab.num_rows, np.random.default_rng([seed, bucket]))))
        tab = tab.append_column("__place", pa.array(np.arange(tab.num_rows)))
        yield from tab.to_batches(max_chunksize=2_000)
    return run


def shuffle(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written, shuffled buckets: doc_id, text, size, text_crc32, bucket, place (from 0 in each)."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), size.alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    # ordered within a partition, so that a record's number does not depend on how its rows arrived
    record = base.sortWithinPartitions("doc_id", "text_crc32").withColumn("__record", F.monotonically_increasing_id())
    key = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "__record")
    scattered = (record.repartition(buckets, key).withColumn("__bucket", F.spark_partition_id())
                 .sortWithinPartitions("doc_id", "text_crc32", "__record").drop("__record"))
    ddl = "doc_id long, text string, size long, text_crc32 long, __bucket int, __place long"
    return written(scattered.mapInArrow(_shuffle_bucket(seed), ddl)).withColumnRenamed("__bucket", "bucket").withColumnRenamed("__place", "place")


def shard(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """The shuffled records with shard and slot (gapless from 0), by the law of equal row counts."""
    rows = shuffle(docs, **options)
    counts = written(rows.groupBy("bucket").agg(F.count("*").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # one row for each bucket
    starts = counts.select(F.col("bucket").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    out = rows.join(starts, rows["bucket"] == F.col("__b")).withColumn("at", F.col("first") + F.col("place"))
    # shard s holds the places from ceil(s * total / shards) on
    out = out.withColumn("shard", F.expr(f"int((at * {shards}) div {max(total, 1)})"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return out.withColumn("slot", F.col("at") - first).drop("__b", "first", "at", "bucket", "place")


def write_shards(docs: DataFrame, path: str | None = None, **options) -> str:
    """Write the shards as ``shard=N`` folders, rows in slot order within each file; returns the path."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}"
    out = shard(docs, **options)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def sharding_digest(docs: DataFrame, shards: int = SHARDS, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every record."""
    return shard(docs, shards, **options).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
