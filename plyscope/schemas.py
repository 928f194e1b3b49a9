"""Explicit schemas of every source: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()

GAME_STRING_FIELDS = (
    "url", "pgn", "time_control", "tcn", "game_uuid", "initial_setup", "fen", "time_class", "rules",
)
SIDE_STRING_FIELDS = ("username", "result", "id", "uuid")

# staging.games: one row per (load, tracked player, game).
GAMES = T.StructType([
    T.StructField("archive_url", _S),
    T.StructField("username", _S),
    T.StructField("bq_load_date", _S),
    T.StructField("url", _S),
    T.StructField("pgn", _S),
    T.StructField("time_control", _S),
    T.StructField("end_time_integer", _L),
    T.StructField("rated", T.BooleanType()),
    T.StructField("tcn", _S),
    T.StructField("game_uuid", _S),
    T.StructField("initial_setup", _S),
    T.StructField("fen", _S),
    T.StructField("time_class", _S),
    T.StructField("rules", _S),
    T.StructField("white_username", _S),
    T.StructField("white_rating", _L),
    T.StructField("white_result", _S),
    T.StructField("white_id", _S),
    T.StructField("white_uuid", _S),
    T.StructField("black_username", _S),
    T.StructField("black_rating", _L),
    T.StructField("black_result", _S),
    T.StructField("black_id", _S),
    T.StructField("black_uuid", _S),
])

# staging.games_moves: one row per (load, game, ply); score after the move, white's view.
MOVES = T.StructType([
    T.StructField("game_uuid", _S),
    T.StructField("move_number", _L),
    T.StructField("move", _S),
    T.StructField("score_white", _L),
])

USERNAME_MAPPING = T.StructType([
    T.StructField("username", _S),
    T.StructField("target_username", _S),
])

_SIDE = T.StructType([
    T.StructField("username", _S),
    T.StructField("rating", _L),
    T.StructField("result", _S),
    T.StructField("@id", _S),
    T.StructField("uuid", _S),
])

# One monthly archive object as published by the game server: {"games": [...]}.
ARCHIVE = T.StructType([
    T.StructField("games", T.ArrayType(T.StructType([
        T.StructField("url", _S),
        T.StructField("pgn", _S),
        T.StructField("time_control", _S),
        T.StructField("end_time", _L),
        T.StructField("rated", T.BooleanType()),
        T.StructField("tcn", _S),
        T.StructField("uuid", _S),
        T.StructField("initial_setup", _S),
        T.StructField("fen", _S),
        T.StructField("time_class", _S),
        T.StructField("rules", _S),
        T.StructField("white", _SIDE),
        T.StructField("black", _SIDE),
    ]))),
])

HISTORY = T.StructType([
    T.StructField("username", _S),
    T.StructField("latest_archive_url", _S),
    T.StructField("latest_end_time", _L),
])

ARCHIVE_LIST = T.StructType([
    T.StructField("username", _S),
    T.StructField("archive_url", _S),
])

LOAD_PARTITION = "load_ts"
