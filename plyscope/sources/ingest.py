"""Incremental ingest of monthly game archives into dated Parquet snapshots.

Landing layout: one JSON object ``{"games": [...]}`` per player and month, as fetched from the
archive service, stored Hive-style as ``{landing}/username={name}/archive={yyyy}-{MM}/*.json`` so
the player and month come from partition discovery. The archive URL of a row is
``{archive_base}{name}/games/{yyyy}/{MM}``; its last seven characters are the month.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope import schemas
from plyscope.params import Params
from plyscope.session import landed
from plyscope.sources import quarantine

ARCHIVE_BASE = "https://api.example.invalid/pub/player/"
# Up to so many players of a load are named in the partition filter.
PRUNE_PLAYERS = 1000
# Up to so many selected archives (two short names each) are broadcast, so that no archive's text is shuffled.
BROADCAST_ARCHIVES = 500_000
LANDING_SCHEMA = T.StructType([*schemas.ARCHIVE.fields, T.StructField("username", T.StringType()),
                               T.StructField("archive", T.StringType())])


def _default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def flatten_archive_games(archives: DataFrame, load_time: str) -> DataFrame:
    """S3 + S13: exploded archive objects → staging rows, defaults for missing fields, audit columns.

    ``archives`` has the ARCHIVE columns plus ``username`` and ``archive_url``.
    """
    return flatten_games(archives.select("archive_url", "username", F.explode("games").alias("g")), load_time)


def flatten_games(g: DataFrame, load_time: str) -> DataFrame:
    """games (``g``) with ``username`` and ``archive_url`` → staging rows."""
    cols = [F.col("archive_url"), F.col("username"), F.lit(load_time).alias("bq_load_date")]
    for name in ("url", "pgn", "time_control"):
        cols.append(_default(F.col(f"g.{name}"), "").alias(name))
    cols += [_default(F.col("g.end_time"), 0).cast("bigint").alias("end_time_integer"),
             _default(F.col("g.rated"), False).alias("rated"),
             _default(F.col("g.tcn"), "").alias("tcn"),
             _default(F.col("g.uuid"), "").alias("game_uuid")]
    for name in ("initial_setup", "fen", "time_class", "rules"):
        cols.append(_default(F.col(f"g.{name}"), "").alias(name))
    for side in ("white", "black"):
        cols += [_default(F.col(f"g.{side}.username"), "").alias(f"{side}_username"),
                 F.col(f"g.{side}.rating").cast("bigint").alias(f"{side}_rating"),  # NULL when absent
                 _default(F.col(f"g.{side}.result"), "").alias(f"{side}_result"),
                 _default(F.col(f"g.{side}.`@id`"), "").alias(f"{side}_id"),
                 _default(F.col(f"g.{side}.uuid"), "").alias(f"{side}_uuid")]
    return g.select(*cols)


def with_archive_identity(raw: DataFrame, archive_base: str = ARCHIVE_BASE) -> DataFrame:
    """(username, archive_url) of each landed archive object, from its partition values."""
    return raw.select("games", "username", _archive_url(archive_base).alias("archive_url"))


def _archive_url(archive_base: str) -> Column:
    return F.concat(F.lit(archive_base), F.col("username"), F.lit("/games/"),
                    F.regexp_replace(F.col("archive"), "-", "/"))


def read_archive_json(spark: SparkSession, landing: str, archive_base: str = ARCHIVE_BASE) -> DataFrame:
    """S3: landed archive files → one row per archive with its games array. For files known to be sound;
    loads go through ``quarantine``, which also accounts for what cannot be read."""
    raw = spark.read.schema(LANDING_SCHEMA).json(landing)
    return with_archive_identity(raw, archive_base)


def list_archives(spark: SparkSession, landing: str) -> DataFrame:
    """(username, archive) of the landing zone's objects, from their paths: no object is opened. Hive
    style escapes in the names are undone."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path").distinct()
    part = lambda k: F.url_decode(F.replace(F.regexp_extract("path", f"/{k}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    return names.select(part("username").alias("username"), part("archive").alias("archive")).distinct()


def read_selected_lines(spark: SparkSession, landing: str, history: DataFrame, params: Params,
                        archive_base: str = ARCHIVE_BASE) -> DataFrame:
    """S6 and S7 before the read: the archives to load are selected from the listing by history and
    month; their lines are returned. The earliest selected month, and the players where they are few, prune the partitions that
    are opened; a semi join keeps exactly the selected archives. Their list is written first: its size is known then."""
    listed = list_archives(spark, landing)
    keep = filter_archives_by_min_month(
        filter_archives_by_history(listed.withColumn("archive_url", _archive_url(archive_base)), history), params.min_archive)
    keep = landed(keep.select("username", "archive"), "archives")
    first, players, archives = keep.agg(F.min("archive"), F.count_distinct("username"), F.count("*")).first()
    raw = quarantine.read_lines(spark, landing).filter(F.col("archive") >= (first or "9999-99"))
    if 0 < players <= PRUNE_PLAYERS:
        raw = raw.filter(F.col("username").isin([r[0] for r in keep.select("username").distinct().collect()]))
    kept = keep.select(F.col("username").alias("__u"), F.col("archive").alias("__a"))
    kept = F.broadcast(kept) if archives <= BROADCAST_ARCHIVES else kept
    return raw.join(kept, (raw["username"] == kept["__u"]) & (raw["archive"] == kept["__a"]), "left_semi")


def archive_game() -> Column:
    """A staging row's game as the object that an archive lists."""
    side = lambda s: F.struct(F.col(f"{s}_username").alias("username"), F.col(f"{s}_rating").alias("rating"),
                              F.col(f"{s}_result").alias("result"), F.col(f"{s}_id").alias("@id"),
                              F.col(f"{s}_uuid").alias("uuid"))
    return F.struct("url", "pgn", "time_control", F.col("end_time_integer").alias("end_time"), "rated", "tcn",
                    F.col("game_uuid").alias("uuid"), "initial_setup", "fen", "time_class", "rules",
                    side("white").alias("white"), side("black").alias("black"))


def land_archives(games: DataFrame, landing: str, games_per_object: int = 200) -> None:
    """Write staging-shaped games back as archive objects in the landing layout (fixtures, replays).

    A (player, month) becomes as many objects as it needs, of about ``games_per_object`` games each,
    one object per line: no row grows with the archive. Rows are dealt to objects by a hash of the game."""
    game = archive_game()
    keys = ["username", "archive"]
    dated = games.withColumn("archive", F.regexp_replace(F.right("archive_url", F.lit(7)), "/", "-"))
    objects = dated.groupBy(*keys).agg(F.ceil(F.count("*") / games_per_object).alias("__objects"))
    dealt = dated.join(objects, keys).withColumn("__object", F.pmod(F.xxhash64("url", "game_uuid", "end_time_integer"), "__objects"))
    (dealt.groupBy(*keys, "__object").agg(F.collect_list(game).alias("games")).drop("__object")
     .write.mode("overwrite").partitionBy(*keys).json(landing))


def read_snapshots(spark: SparkSession, root: str, schema) -> DataFrame:
    """Union of every dated snapshot under ``root`` (``load_ts=`` partitions); an empty
    frame with the schema on the first load."""
    full = schema if schemas.LOAD_PARTITION in schema.names else \
        T.StructType([*schema.fields, T.StructField(schemas.LOAD_PARTITION, T.StringType())])
    try:
        return spark.read.schema(full).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing root means "first load"
            raise
        return spark.createDataFrame([], full)


def read_username_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The alias seed (CSV with header)."""
    return spark.read.schema(schemas.USERNAME_MAPPING).option("header", True).csv(path)


def load_history(games: DataFrame) -> DataFrame:
    """Per-player high-water marks of what is already loaded."""
    return games.groupBy("username").agg(F.max("archive_url").alias("latest_archive_url"),
                                         F.max("end_time_integer").alias("latest_end_time"))


def filter_archives_by_history(archives: DataFrame, history: DataFrame) -> DataFrame:
    """Keep an archive if its player is unseen or it is at/after the latest loaded one (inclusive,
    string order); the latest month is re-read because it may have grown."""
    h = history.select(F.col("username").alias("__u"), "latest_archive_url")
    j = archives.join(h, archives["username"] == h["__u"], "left")
    latest = F.col("latest_archive_url")
    return j.filter(latest.isNull() | (latest == F.lit("")) | (F.col("archive_url") >= latest)) \
            .drop("__u", "latest_archive_url")


def filter_archives_by_min_month(archives: DataFrame, min_archive: str | None) -> DataFrame:
    """Keep archives whose month (last 7 characters, 'yyyy/MM') is ≥ ``min_archive``; no-op if unset."""
    if not min_archive:
        return archives
    return archives.filter(F.right(F.col("archive_url"), F.lit(7)) >= F.lit(min_archive))


def filter_new_games(games: DataFrame, history: DataFrame) -> DataFrame:
    """Keep games that ended strictly after the player's latest loaded game (0 when unseen).

    A game ending earlier than that mark but arriving later is not loaded (same as the reference).
    """
    h = history.select(F.col("username").alias("__u"), "latest_end_time")
    j = games.join(h, games["username"] == h["__u"], "left")
    return j.filter(F.col("end_time_integer") > F.coalesce(F.col("latest_end_time"), F.lit(0))) \
            .drop("__u", "latest_end_time")


def load_suffix(now: _dt.datetime | None = None) -> str:
    """the snapshot suffix ``yyyyMMdd_HHmm`` of a load."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M")


def append_snapshot(df: DataFrame, root: str, load_ts: str) -> None:
    """Write one dated batch as partition ``load_ts=…``.

    Dynamic partition overwrite replaces only a batch of the same minute and writes nothing (no
    partition) when the batch is empty, without a separate emptiness action.
    """
    (df.withColumn(schemas.LOAD_PARTITION, F.lit(load_ts))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(schemas.LOAD_PARTITION).parquet(root))


def materialize_table(df: DataFrame, path: str, sort_within: list | None = None,
                      partition_by: list[str] | None = None) -> None:
    """Drop-and-create a table (Parquet files at ``path``), optionally partitioned."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


_TEXT, _COUNT = T.StringType(), T.LongType()
REJECTS = T.StructType([T.StructField(n, _TEXT) for n in ("file", "username", "archive", "reason", "raw", schemas.LOAD_PARTITION)])
ACCOUNTS = T.StructType([
    *[T.StructField(n, _TEXT) for n in ("file", "username", "archive")],
    *[T.StructField(n, _COUNT) for n in ("lines", "broken_lines", "games_read", "games_kept", *[f"rejected_{r}" for r in quarantine.REASONS])],
    T.StructField(schemas.LOAD_PARTITION, _TEXT)])


def rejects_root(games_root: str) -> str:
    """Where the rejects of the loads into ``games_root`` go."""
    return f"{games_root.rstrip('/')}_rejects"


def accounts_root(games_root: str) -> str:
    """Where the per-file accounts of the loads into ``games_root`` go."""
    return f"{games_root.rstrip('/')}_accounts"


def append_lines(lines: DataFrame, history: DataFrame, games_root: str, now: _dt.datetime, load_ts: str,
                 archive_base: str = ARCHIVE_BASE) -> None:
    """Archive lines (file, username, archive, value) → the load's snapshot of new games (S8), its rejects
    and its account of every file read. The lines are parsed once."""
    parsed = landed(quarantine.parse_lines(lines), "parsed")
    games = quarantine.kept(parsed).withColumn("archive_url", _archive_url(archive_base))
    batch = filter_new_games(flatten_games(games, now.strftime("%Y-%m-%d %H:%M:%S")), history)
    append_snapshot(quarantine.rejects(parsed), rejects_root(games_root), load_ts)
    append_snapshot(quarantine.account(parsed), accounts_root(games_root), load_ts)
    append_snapshot(batch, games_root, load_ts)


def load_games(spark: SparkSession, landing: str, games_root: str, params: Params = Params(),
               now: _dt.datetime | None = None, archive_base: str = ARCHIVE_BASE) -> str:
    """Entry 1 on landed files: archive selection from the listing (S6, S7) → lines parsed, with
    rejects and an account per file beside the games (S3) → new games only (S8). Returns the load
    suffix used. An archive that is read again (the latest month) is accounted for again."""
    now = now or _dt.datetime.now()
    history = load_history(read_snapshots(spark, games_root, schemas.GAMES))
    lines = read_selected_lines(spark, landing, history, params, archive_base)
    ts = load_suffix(now)
    append_lines(lines, history, games_root, now, ts, archive_base)
    return ts


def select_unscored_games(games: DataFrame, moves: DataFrame, keep_keyless: bool = True) -> DataFrame:
    """Processable games with no scored move yet, one row per game (the latest load wins, then
    the larger player name).

    Only narrow key columns go through the anti join and the per-game choice; the full rows (with
    the move text) are fetched for the chosen keys by a semi join, which AQE broadcasts when the
    day's work list is small, so the history of move texts is not shuffled.
    """
    scored = moves.select("game_uuid").distinct()
    ok = games.filter((F.length("pgn") > 0) & (F.col("rules") == F.lit("chess")))
    if not keep_keyless:  # else all of them fold into one work item, as one game without a uuid
        ok = ok.filter(F.col("game_uuid") != F.lit(""))
    order = schemas.LOAD_PARTITION if schemas.LOAD_PARTITION in games.columns else "bq_load_date"
    keys = (ok.select("game_uuid", "username", order)
            .join(scored, "game_uuid", "left_anti")
            .groupBy("game_uuid")
            .agg(F.max_by(F.struct("username", order), F.struct(order, "username")).alias("__k"))
            .select("game_uuid", F.col("__k.username").alias("username"), F.col(f"__k.{order}").alias(order)))
    # the same row loaded twice in one batch would match twice: keep one per game
    return ok.join(keys, ["game_uuid", "username", order], "left_semi").dropDuplicates(["game_uuid"])
