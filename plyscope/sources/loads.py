"""Loads that are published whole, with the high-water marks they leave.

Beside the dated snapshots of ``ingest`` (whose readers list folders), this form keeps, below one root:

- ``data/``: what each load wrote, one Parquet folder per table (games, rejects, accounts);
- ``marks/``: per player the latest archive and game after a load, one small table each;
- ``commits/``: one JSON entry per version, naming the folders of every table and the marks.

A load writes its data and the merged marks first and then its entry, by a rename that fails where the
entry exists (the file system must have an atomic rename, as HDFS does). Readers open the newest entry and only
what it names, so a load that was killed midway is invisible, all tables and marks of a load
appear together, and of two loads that started from the same version one is refused (``LoadConflict``)
and is run again. A load reads the marks, never old games. Two loads in the same minute are both kept, where a dated
snapshot of the same minute is replaced. ``compact`` rewrites a table's loads as one; the older versions stay readable.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope import schemas
from plyscope.params import Params
from plyscope.session import landed
from plyscope.sources import ingest, quarantine

NUMBER = T.StructField("load_no", T.LongType())
_ENTRY = "version bigint, marks string, tables map<string, array<string>>"


class LoadConflict(RuntimeError):
    """Another load was published since this one began; nothing of this one is visible."""


@dataclass(frozen=True)
class Version:
    """A published state: folders of each table and of the marks, relative to the root."""
    number: int = 0
    marks: str | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published version numbers, from the names of the entries."""
    try:
        names = spark.read.format("binaryFile").load(f"{root}/commits/*.json").select(
            F.regexp_extract("path", r"(\d+)\.json$", 1).cast("int").alias("n"))
        return sorted(r.n for r in names.collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing root means "no load yet"
            raise
        return []


def _entry(root: str, number: int) -> str:
    return f"{root}/commits/{number:010d}.json"


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest published version, or the one of that number; version 0 before the first load."""
    if number is None:
        number = max(versions(spark, root), default=0)
    if number == 0:
        return Version()
    r = spark.read.schema(_ENTRY).json(_entry(root, number)).first()
    return Version(r.version, r.marks, {k: list(v) for k, v in r.tables.items()})


def _commit(spark: SparkSession, root: str, made: Version) -> Version:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs
    target, draft = fs.Path(_entry(root, made.number)), fs.Path(f"{root}/commits/_draft-{uuid.uuid4().hex}")
    out = draft.getFileSystem(conf).create(draft, False)
    out.write(bytearray(json.dumps({"version": made.number, "marks": made.marks, "tables": made.tables}).encode()))
    out.close()
    no_options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, no_options)
    except Py4JJavaError as e:
        draft.getFileSystem(conf).delete(draft, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        raise LoadConflict(f"version {made.number} of {root} is published already") from None
    return made


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType, at: Version | None = None) -> DataFrame:
    """A table of the newest (or the given) version: its rows with ``load_ts`` and ``load_no``."""
    at = at or version(spark, root)
    names = [schemas.LOAD_PARTITION, NUMBER.name]
    full = T.StructType([*[f for f in schema.fields if f.name not in names],
                         T.StructField(schemas.LOAD_PARTITION, T.StringType()), NUMBER])
    paths = [f"{root}/{p}" for p in at.tables.get(table, [])]
    return spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)


def read_marks(spark: SparkSession, root: str, at: Version | None = None) -> DataFrame:
    """The marks that the version's last load left."""
    at = at or version(spark, root)
    return spark.read.schema(schemas.HISTORY).parquet(f"{root}/{at.marks}") if at.marks \
        else spark.createDataFrame([], schemas.HISTORY)


def write_load(spark: SparkSession, root: str, tables: dict[str, DataFrame], load_ts: str, start: Version) -> Version:
    """Everything of a load but its entry: the version that ``publish`` makes visible."""
    load, number = uuid.uuid4().hex, start.number + 1
    after = {t: list(p) for t, p in start.tables.items()}
    for table, df in tables.items():
        path = f"data/{load}/{table}"
        df.withColumns({schemas.LOAD_PARTITION: F.lit(load_ts), NUMBER.name: F.lit(number).cast("bigint")}).write.parquet(f"{root}/{path}")
        after.setdefault(table, []).append(path)
    marks = read_marks(spark, root, start)
    if "games" in tables:
        new = ingest.load_history(spark.read.schema(schemas.GAMES).parquet(f"{root}/data/{load}/games"))
        marks = marks.unionByName(new).groupBy("username").agg(
            F.max("latest_archive_url").alias("latest_archive_url"), F.max("latest_end_time").alias("latest_end_time"))
    marks.write.parquet(f"{root}/marks/{load}")
    return Version(number, f"marks/{load}", after)


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], load_ts: str, start: Version | None = None) -> Version:
    """Write a load's tables and publish them together, on top of the version the load started from."""
    return _commit(spark, root, write_load(spark, root, tables, load_ts, start or version(spark, root)))


def new_tables(spark: SparkSession, landing: str, root: str, start: Version, params: Params, now: _dt.datetime,
               archive_base: str = ingest.ARCHIVE_BASE) -> dict[str, DataFrame]:
    """Games, rejects and accounts of the landed archives that the marks select."""
    marks = read_marks(spark, root, start)
    parsed = landed(quarantine.parse_lines(ingest.read_selected_lines(spark, landing, marks, params, archive_base)), "parsed")
    games = quarantine.kept(parsed).withColumn("archive_url", ingest._archive_url(archive_base))
    return {"games": ingest.filter_new_games(ingest.flatten_games(games, now.strftime("%Y-%m-%d %H:%M:%S")), marks),
            "rejects": quarantine.rejects(parsed), "accounts": quarantine.account(parsed)}


def load_published(spark: SparkSession, landing: str, root: str, params: Params = Params(),
                   now: _dt.datetime | None = None, archive_base: str = ingest.ARCHIVE_BASE) -> Version:
    """Entry 1 as one published load; a repeated load publishes no game twice."""
    now = now or _dt.datetime.now()
    start = version(spark, root)
    return publish(spark, root, new_tables(spark, landing, root, start, params, now, archive_base), ingest.load_suffix(now), start)


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType) -> Version:
    """The loads of a table as one folder of well-sized files; rows, load columns and marks stay."""
    start = version(spark, root)
    if len(start.tables.get(table, [])) < 2:
        return start
    path = f"data/{uuid.uuid4().hex}/{table}"
    read_table(spark, root, table, schema, start).hint("rebalance").write.parquet(f"{root}/{path}")
    return _commit(spark, root, replace(start, number=start.number + 1, tables={**start.tables, table: [path]}))
