"""Archive lines whose content cannot all be read (S3, F28): nothing is lost uncounted.

A landed archive file holds one object ``{"games": [...]}`` per line. Each line is parsed permissively.
Its games are taken one by one, so one bad game does not cost the others. A line that is no valid
object (cut off, damaged) is searched for whole game objects by a depth automaton over its JSON
tokens: those before the damage are kept, what is left of the line is one fragment. Rejects keep their
raw text and the reason:

- ``line``: a line that is neither an object with a list of games nor the damaged start of one with a game in it;
- ``fragment``: the unreadable rest of such a line, from the first game that is not whole;
- ``element``: an entry of the list that is no object;
- ``field``: a game with a field of another type than the schema's.

Missing fields are no fault: they take their defaults in ``ingest.flatten_games``. Blank lines are skipped.
Every (file, line) is accounted for: games read = kept + rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyscope import schemas
from plyscope.functions.nesting import inside

LINES_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("username", T.StringType()),
                             T.StructField("archive", T.StringType())])
CORRUPT = "_corrupt"
GAME_TYPE = schemas.ARCHIVE["games"].dataType.elementType
# fixed values: the tokens of JSON text (strings, brackets, all else; a quote that is never closed)
JSON_TOKENS = r'"(?:[^"\\]++|\\.)*+"|[{}\[\]]|[^"{}\[\]]++|"'
ARCHIVE_HEAD = r'^\s*\{\s*"games"\s*:\s*\['
REASONS = ("line", "fragment", "element", "field")
#: a game object is the third level of a line: object, list, object
GAME_LEVEL = 3


def read_lines(spark: SparkSession, landing: str) -> DataFrame:
    """(file, username, archive, value) of every landed line."""
    return spark.read.schema(LINES_SCHEMA).text(landing).select(F.col("_metadata.file_path").alias("file"), "username", "archive", "value")


def parse_lines(lines: DataFrame) -> DataFrame:
    """One row per game, fragment or unreadable line: the columns of ``lines`` but ``value``, then ``raw`` and ``reason``
    (NULL for a game that is kept, whose text is in ``g``) and ``g``, the game; lines without games give one row without ``raw``."""
    pieces = "array<struct<text:string,complete:boolean>>"
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    line = F.from_json("value", f"games array<string>, {CORRUPT} string", opts)
    tokens = F.regexp_extract_all("value", F.lit(JSON_TOKENS), F.lit(0))
    read = lines.filter(F.trim("value") != "").withColumn("line", line)
    whole = F.col(f"line.{CORRUPT}").isNull() & F.col("line.games").isNotNull()
    listed = F.transform("line.games", lambda t: F.struct(t.alias("text"), F.lit(True).alias("complete")))
    # only a damaged archive object is searched, not valid JSON of another shape
    damaged = F.col(f"line.{CORRUPT}").isNotNull() & F.col("value").rlike(ARCHIVE_HEAD)
    found = F.when(whole, listed).when(damaged, inside(tokens, ("{", "["), ("}", "]"), GAME_LEVEL))
    nothing = F.array(F.struct(F.when(~whole, F.col("value")).alias("text"), F.lit(None).cast("boolean").alias("complete")))
    read = read.withColumn("found", found.cast(pieces))
    read = read.withColumn("found", F.when(F.size("found") > 0, F.col("found")).otherwise(nothing.cast(pieces)))
    keep = [c for c in lines.columns if c != "value"]
    each = read.select(*keep, whole.alias("whole"), F.posexplode("found").alias("place", "p"))
    schema = T.StructType([*GAME_TYPE.fields, T.StructField(CORRUPT, T.StringType())])
    game = F.when(F.col("p.complete"), F.from_json("p.text", schema, opts))
    each = each.withColumn("g", game)
    counted = F.col("p.complete").isNotNull()
    reason = (F.when(counted & ~F.col("p.complete"), F.lit("fragment"))
              .when(~counted & ~F.col("whole"), F.lit("line"))
              .when(counted & (F.col("p.text").isNull() | ~F.ltrim("p.text").startswith("{")), F.lit("element"))
              .when(F.col(f"g.{CORRUPT}").isNotNull(), F.lit("field")))
    fields = F.struct(*[F.col(f"g.`{f.name}`").alias(f.name) for f in GAME_TYPE.fields])
    return each.select(
        *keep, "whole", "place", counted.alias("is_game"), F.when(reason.isNotNull(), F.coalesce("p.text", F.when(counted, F.lit("null")))).alias("raw"),
        reason.alias("reason"), F.when(counted & reason.isNull(), fields).alias("g"))


def kept(parsed: DataFrame) -> DataFrame:
    """The readable games, as rows with ``g``."""
    return parsed.filter(F.col("is_game") & F.col("reason").isNull()).drop("raw", "reason", "is_game", "whole", "place")


def rejects(parsed: DataFrame) -> DataFrame:
    """What could not be read: file, username, archive, reason, raw."""
    return parsed.filter(F.col("reason").isNotNull()).select("file", "username", "archive", "reason", "raw")


def account(parsed: DataFrame) -> DataFrame:
    """Per file: lines, lines that are no valid archive object, games read, kept and rejected, by reason."""
    first = F.col("place") == 0     # one row of each line
    game = F.col("is_game")
    return parsed.groupBy("file", "username", "archive").agg(
        F.count_if(first).alias("lines"), F.count_if(first & ~F.col("whole")).alias("broken_lines"),
        F.count_if(game).alias("games_read"), F.count_if(game & F.col("reason").isNull()).alias("games_kept"),
        *[F.count_if(F.col("reason") == r).alias(f"rejected_{r}") for r in REASONS])
