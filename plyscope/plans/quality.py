"""Data-quality checks (K1–K4): each returns the failing rows as a DataFrame; ``report`` counts them
and applies the warn/error limits, all in Spark (no rows pulled to the driver)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.functions import core as fx
from plyscope.params import BLACK_MOVE_NUMBER_PATTERN, WHITE_MOVE_NUMBER_PATTERN, Params

# Columns the reference declares NOT NULL, per model.
NOT_NULL_GAMES = ("username", "game_uuid", "playing_as", "playing_result_detailed", "playing_rating",
                  "opponent_rating")
NOT_NULL_MOVES = ("game_uuid", "move_number", "score_white")


def not_null_failures(df: DataFrame, model: str, columns) -> DataFrame:
    """K1: one row per (model, column) with the number of NULLs, from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.select(F.lit(model).alias("model"),
                         F.expr(f"stack({len(columns)}, {stack}) AS (column_name, failures)"))


def not_null_report(games_df: DataFrame, moves_df: DataFrame) -> DataFrame:
    return not_null_failures(games_df, "games", NOT_NULL_GAMES).unionByName(
        not_null_failures(moves_df, "games_moves", NOT_NULL_MOVES))


def move_number_consistency(games_df: DataFrame, moves_df: DataFrame) -> DataFrame:
    """K2: games whose first or last ply differs between the clock marks and the scored moves.

    Clock plies of a game run 1..number of marks, so their bounds come from the mark count without
    exploding; move bounds are aggregated first and only then restricted to known games.
    """
    n = F.size(fx.clock_marks("pgn"))
    times = (games_df.select("game_uuid", n.alias("__n")).filter(F.col("__n") > 0)
             .groupBy("game_uuid")
             .agg(F.max("__n").cast("bigint").alias("max_move_number_times"),
                  F.lit(1).cast("bigint").alias("min_move_number_times")))
    known = games_df.select("game_uuid").distinct()
    moves = (moves_df.groupBy("game_uuid")
             .agg(F.max("move_number").alias("max_move_number_moves"),
                  F.min("move_number").alias("min_move_number_moves"))
             .join(known, "game_uuid", "left_semi"))
    # Full outer join + (a <> b OR c <> d) keeps only games present on both sides.
    return (times.join(moves, "game_uuid", "full")
            .filter((F.col("max_move_number_times") != F.col("max_move_number_moves"))
                    | (F.col("min_move_number_times") != F.col("min_move_number_moves"))))


def _max_printed(pgn, pattern: str):
    return F.array_max(F.transform(F.regexp_extract_all(pgn, F.lit(pattern), 1), lambda x: x.cast("bigint")))


def _incomplete(games_df: DataFrame, moves_df: DataFrame) -> DataFrame:
    """K3's failing (player, game) pairs with their counts, without the text."""
    per_row = games_df.select("username", "game_uuid",
                              _max_printed(F.col("pgn"), WHITE_MOVE_NUMBER_PATTERN).alias("p1"),
                              _max_printed(F.col("pgn"), BLACK_MOVE_NUMBER_PATTERN).alias("p2"))
    # one text per pair, as a rule; where there are several (keyless games) the largest, not any
    g = per_row.groupBy("username", "game_uuid").agg(F.max(F.struct("p1", "p2")).alias("__p"))
    m = moves_df.groupBy("game_uuid").agg(F.count(F.lit(1)).alias("nb_moves"))
    z = F.lit(0)
    return (g.join(m, "game_uuid", "left")
            .select("username", "game_uuid", "nb_moves", F.col("__p.p1").alias("nb_move_p1"),
                    F.col("__p.p2").alias("nb_move_p2"))
            .filter(F.coalesce("nb_move_p1", z) + F.coalesce("nb_move_p2", z) != F.coalesce("nb_moves", z)))


def processing_completeness(games_df: DataFrame, moves_df: DataFrame) -> DataFrame:
    """K3: (player, game) whose printed half-move count differs from the number of scored rows
    (unscored games, duplicated move rows, partially scored games).

    The printed counts are taken map-side from each game row, so only (player, game, two numbers)
    is shuffled; the move text is joined back to the failing pairs, which are computed once.
    """
    bad = _incomplete(games_df, moves_df)
    keys = ["username", "game_uuid"]
    found = bad.join(games_df.select(*keys, "pgn"), keys)
    return (found.groupBy(*keys).agg(F.max("pgn").alias("pgn"),
                                     *[F.any_value(c).alias(c) for c in ("nb_moves", "nb_move_p1", "nb_move_p2")])
            .select("username", "game_uuid", "pgn", "nb_moves", "nb_move_p1", "nb_move_p2"))


def severity(failures, p: Params = Params()):
    """K4: pass / warn (> warn_if) / error (> error_if)."""
    return (F.when(failures > p.error_if, F.lit("error"))
             .when(failures > p.warn_if, F.lit("warn"))
             .otherwise(F.lit("pass")))


def keyless(games_df: DataFrame, moves_df: DataFrame) -> DataFrame:
    """Rows without a game uuid, per model: they cannot be matched, whatever ``keep_keyless`` says."""
    count = lambda df, model: df.agg(F.count_if(F.col("game_uuid") == F.lit("")).alias("failures")).select(
        F.lit(model).alias("model"), "failures")
    return count(games_df, "games").unionByName(count(moves_df, "games_moves"))


def report(games_df: DataFrame, moves_df: DataFrame, params: Params = Params()) -> DataFrame:
    """All checks as one DataFrame: (check_name, failures, status)."""
    nn = not_null_report(games_df, moves_df).select(
        F.concat(F.lit("not_null_"), F.col("model"), F.lit("_"), F.col("column_name")).alias("check_name"),
        F.col("failures").cast("bigint").alias("failures"))
    tests = [("assert_move_number_consistency", move_number_consistency(games_df, moves_df)),
             ("assert_stockfish_processing", _incomplete(games_df, moves_df))]
    counted = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
               for name, df in tests]
    counted.append(keyless(games_df, moves_df).select(F.concat(F.lit("keyless_"), "model").alias("check_name"), "failures"))
    allc = reduce(DataFrame.unionByName, counted, nn)
    return allc.withColumn("status", severity(F.col("failures"), params))
