"""Intermediate models: cleaned games, typed moves and per-ply clocks (lazy DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.functions import core as fx
from plyscope.params import Params


def games(staging_games: DataFrame, params: Params = Params()) -> DataFrame:
    """M1–M5: processable games with local times, the tracked player's side, result and ratings."""
    local = fx.local_datetime("end_time_integer", params.target_timezone)
    side = fx.orient_side("username", "white_username", "black_username")
    detailed = fx.pick_by_side(F.col("playing_as"), "white_result", "black_result")
    return (staging_games
            .filter(fx.is_processable_game())
            .withColumn("end_time", local)
            .withColumns({"end_time_date": fx.local_date(F.col("end_time")),
                          "end_time_month": fx.local_month(F.col("end_time")),
                          "playing_as": side})
            .withColumns({"playing_result_detailed": detailed,
                          "playing_rating": fx.pick_by_side(F.col("playing_as"), "white_rating", "black_rating"),
                          "opponent_rating": fx.pick_by_side(F.col("playing_as"), "black_rating", "white_rating")})
            .withColumn("playing_result", fx.simplify_result(F.col("playing_result_detailed"))))


def games_moves(staging_moves: DataFrame, params: Params = Params()) -> DataFrame:
    """M6–M7: ply colour, black's score and both win probabilities."""
    s = F.col("score_white")
    p_white = fx.win_probability(s, params.win_probability_slope)
    return (staging_moves
            .withColumn("move_number", F.col("move_number").cast("bigint"))
            .withColumns({"player_color_turn": fx.turn_color("move_number"),
                          "score_black": -s,
                          "win_probability_white": p_white,
                          "win_probability_black": F.lit(1.0) - p_white}))


def games_times(games_df: DataFrame) -> DataFrame:
    """M8–M9: one row per clock mark of each (player, game): ply = position + 1, seconds left."""
    return (games_df
            .select("username", "game_uuid", F.posexplode(fx.clock_marks("pgn")).alias("pos", "time_remaining"))
            .select("username", "game_uuid", "time_remaining",
                    (F.col("pos") + 1).cast("bigint").alias("move_number"),
                    fx.clock_to_seconds(F.col("time_remaining")).alias("time_remaining_seconds")))
