"""Helpers shared by the operators: written tables in the shared folder, row ids, column names."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plyscope.session import checkpoint_dir, ship_code

RID = "__rid"
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back: cuts lineage in storage
    that all executors share, and gives Catalyst a true size to choose joins by."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def scope():
    """Collects the paths that ``written`` makes inside, for ``free``."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN.pop()


def free(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no later plan reads, wherever they are stored."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: rows that a Python worker is handed at once where rows hold whole texts
TEXT_ROWS = 1_000


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Python workers get batches of at most so many rows of what is run inside: rows that hold whole texts or
    sets are several times in memory while a batch is handed over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of what is run inside are deleted when each run ends; else they stay on the executors' disks
    until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(spark: SparkSession, make) -> DataFrame:
    """The written table of what ``make()`` returns; tables written on the way to it are freed."""
    with scope() as paths:
        out = written(make())
    free(spark, paths[:-1])
    if _OPEN:
        _OPEN[-1].append(paths[-1])
    return out


def with_rid(df: DataFrame) -> DataFrame:
    """``df`` plus ``__rid``, a unique row id that is stable because the rows are written with it."""
    return written(df.withColumn(RID, F.monotonically_increasing_id()))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` plus ``__rid``. Where ``df`` is a file scan, the id is the row's file and place in it, so
    nothing is copied and every later scan finds the same ids; otherwise the rows are written with one."""
    names = [F.col(f"`{c}`") for c in df.columns if c != RID]
    try:
        placed = df.select(*names, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return with_rid(df.select(*names))
    files = placed.select("__file").distinct()
    files = written(files.withColumn("__no", F.row_number().over(W.orderBy("__file")).cast("long")))
    rid = F.shiftleft(F.col("__no"), 36) + F.col("__row")
    return placed.join(files, "__file").select(*names, rid.alias(RID))


def if_small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` marked for broadcast where a count shows that it has at most ``rows`` (narrow) rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: groups of more rows than this are joined to their rows by broadcast: at most one such group per so many rows
HOT = 2_000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> DataFrame:
    """``rows`` left join ``groups`` (one row a key, ``size`` says how many of ``rows`` it has). Large
    groups meet their rows where those lie, so that no task gets all rows of one key."""
    hot = if_small(written(groups.filter(F.col(size) > HOT)))
    rest = rows.join(hot.select(*on), on, "left_anti").join(groups.filter(F.col(size) <= HOT), on, "left")
    return rows.join(hot, on).unionByName(rest)


def ascii_lower(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, LOWER_FROM, LOWER_TO)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns, whatever their
    names, never meet the operator's own. A null text becomes the empty text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors (once per application)."""
    ship_code(spark)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def even_sample(keys: DataFrame, n: int, salt: int = 5):
    """At most ``n`` of the distinct rows (stratum, key) of ``keys``, chosen by a hash of the key, and the
    strata's (distinct) sizes as a dict. All strata have the same quota, but those that are smaller are
    taken whole and leave their share to the others. Of more than ``n`` strata, the largest are taken."""
    keys = written(keys.select("stratum", "key").distinct())
    sizes = {r["stratum"]: r["n"] for r in keys.groupBy("stratum").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "stratum").limit(n).collect()}
    low, high = 0, max(sizes.values(), default=0)
    while low < high:   # the largest quota that keeps the sum within n
        quota = (low + high + 1) // 2
        low, high = (quota, high) if sum(min(v, quota) for v in sizes.values()) <= n else (low, quota - 1)
    # by a threshold first, with a margin, so that only about the quota's rows are ranked
    shares = [(k, min(1.0, (low + 6 * low ** 0.5 + 6) / v)) for k, v in sizes.items()]
    kind = keys.schema["stratum"].dataType.simpleString()
    shares = keys.sparkSession.createDataFrame(shares, f"stratum {kind}, share double")
    order = F.xxhash64(F.col("key"), F.lit(salt))
    near = keys.join(F.broadcast(shares), "stratum").filter(F.pmod(order, F.lit(1 << 40)) <= F.col("share") * (1 << 40))
    near = near.withColumn("__place", F.row_number().over(W.partitionBy("stratum").orderBy(order, "key")))
    return near.filter(F.col("__place") <= low).select("stratum", "key"), sizes


def bounded_sample(rows: DataFrame, n: int, id_col: str = "doc_id", salt: int = 5) -> DataFrame:
    """At most ``n`` of the rows, chosen by a hash of the id (all of them where they are no more)."""
    total = rows.select(id_col).count()
    if total > n:
        share = int(1_000_000 * min(1.0, 1.1 * n / total)) + 1
        rows = rows.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(salt)), F.lit(1_000_000)) < share)
    return rows.limit(n)
