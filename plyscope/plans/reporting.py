"""Reporting models: the move-grain table (W) and its two-level aggregate (A)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope import schemas
from plyscope.functions import core as fx
from plyscope.operators import classify as cl
from plyscope.operators import quantiles as qt
from plyscope.operators import sequence as sq
from plyscope.operators.joins import count_over, grid_join
from plyscope.operators.segments import First, Lag, cut_segments, segmented_scan
from plyscope.params import Params

GAME_KEYS = ("game_uuid", "username")
# Ply order inside a (game, player) partition. Two aliases of one person in the same game merge into
# one partition with two rows per ply; their raw account name breaks the tie deterministically. Games
# that share a key (keyless ones, repeated rows) are told apart by URL, move and score.
PLY_ORDER = ("move_number", "__raw_username", "url", "move", "score_white")

GWM_COLUMNS = (
    "game_uuid", "archive_url", "username", "url", "end_time", "end_time_date", "end_time_month",
    "time_class", "time_control", "white_username", "white_rating", "black_username", "black_rating",
    "bq_load_date", "move_number", "time_remaining_seconds", "prct_time_remaining", "move", "game_phase",
    "player_color_turn", "playing_as", "is_playing_turn", "playing_turn_name", "playing_rating",
    "playing_rating_range", "opponent_rating", "opponent_rating_range", "playing_result", "score_playing",
    "win_probability_playing", "prev_score_playing", "variance_score_playing", "miss_category_playing",
    "miss_move_number_playing", "massive_blunder_move_number_playing", "miss_category_opponent",
    "miss_move_number_opponent", "position_status_playing", "prev_position_status_playing",
    "miss_context_playing", "first_blunder_playing_turn_name",
)


def mapping_frame(spark: SparkSession, params: Params = Params()) -> DataFrame:
    """The alias seed held in ``Params`` as a DataFrame (S4 reads the same shape from CSV)."""
    return spark.createDataFrame(list(params.username_mapping), schemas.USERNAME_MAPPING)


def scope_games(games: DataFrame, params: Params = Params()) -> DataFrame:
    """Rated games of the allowed time classes, local date within the last N months."""
    start = fx.month_window_start(params.as_of, params.month_history_depth)
    return (games
            .filter(F.col("end_time_integer") >= fx.epoch_lower_bound(start))  # prunes row groups
            .filter((F.col("end_time_date") >= start) & F.col("rated")
                    & F.col("time_class").isin(*params.time_classes)))


def merge_accounts(games: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace a name by its alias target (case-insensitive), keep it when unmapped."""
    m = mapping.select(F.lower("username").alias("__alias"), F.col("target_username").alias("__target"))
    return (games.join(m, F.lower(games["username"]) == m["__alias"], "left")
            .withColumn("username", F.coalesce(F.col("__target"), games["username"]))
            .drop("__alias", "__target"))


def games_with_moves(games: DataFrame, moves: DataFrame, mapping: DataFrame, params: Params = Params(),
                     game_filter: Column | None = None, segmented_keyless: bool = False,
                     times: DataFrame | None = None) -> DataFrame:
    """One row per (player, game, ply) with swings, miss categories and their context.

    Game-level work (scope, alias, bands, clock seconds) is done before the join so it runs once per
    game; the clock of a ply is read from the game's own array (no exploded clock table, no second
    join). Every window uses the same spec — (game, player) ordered by ply — so the plan has one
    exchange (none when the join already hash-partitions by game) and one sort.

    ``game_filter`` is an optional predicate on game-level columns (e.g. a date window, a class, the
    rating bands). A filter on the finished table cannot be pushed below its windows, so consumers
    that need a subset of games pass it here, where it prunes games before the join.

    ``times`` (``games_times``) makes the clock a join of that table on game, raw player name and ply (J3)
    instead: a (game, player) pair loaded twice then has each ply of each of its rows with the clocks of
    both. Over co-bucketed tables (``sources.bucketed``) that join needs no shuffle either.

    Keyless games (see below) are one hot key. The lazy model gives them to plain windows, one
    partition per player; with ``segmented_keyless`` their pairs are dealt over a grid and scanned in segments
    instead, which lands them in the shared folder, so that no task gets more than a share of them.
    """
    p = params
    scoped = scope_games(games, p).withColumn("__raw_username", F.col("username"))
    g = merge_accounts(scoped, mapping).select(
        "game_uuid", "archive_url", "username", "__raw_username", "url", "end_time", "end_time_date", "end_time_month",
        "time_class", "time_control", "white_username", "white_rating", "black_username", "black_rating",
        "bq_load_date", "playing_as", "playing_rating",
        fx.band_rating(F.col("playing_rating"), p.rating_edges).alias("playing_rating_range"),
        "opponent_rating",
        fx.band_rating(F.col("opponent_rating"), p.rating_edges).alias("opponent_rating_range"),
        "playing_result",
        *([fx.clock_seconds_array("pgn").alias("__secs")] if times is None else []))
    # A missing uuid is loaded as '' (S3 defaults). Such rows share no real key: the join pairs every
    # keyless game with every keyless move. They are kept unless ``keep_keyless`` is switched off, and
    # counted by the quality report either way.
    if not p.keep_keyless:
        g = g.filter(F.col("game_uuid") != F.lit(""))
    if game_filter is not None:
        g = g.filter(game_filter)
    mv = moves.select("game_uuid", "move_number", "move", "player_color_turn", "score_white", "score_black",
                      "win_probability_white", "win_probability_black")
    # No join hint: a small game set (one week, one class) is broadcast at run time or filters the
    # moves scan; otherwise this is a sort-merge join on the game key.
    if not (segmented_keyless and p.keep_keyless):
        return _scanned(_ply_rows(g.join(mv, "game_uuid", "inner"), p, times), p).select(*GWM_COLUMNS)
    key = F.col("game_uuid")
    keyed = g.filter(key != "").join(mv.filter(key != ""), "game_uuid", "inner")
    pairs = grid_join(g.filter(key == ""), mv.filter(key == "").drop("game_uuid"))
    return _scanned(_ply_rows(keyed, p, times), p).select(*GWM_COLUMNS).unionByName(
        _scanned_in_segments(_ply_rows(pairs, p, times), p).select(*GWM_COLUMNS))


def _with_clock(j: DataFrame, times: DataFrame | None) -> DataFrame:
    ply = F.col("move_number")
    if times is None:
        secs = F.col("__secs")
        clock = F.when((ply >= 1) & (ply <= F.size(secs)), F.element_at(secs, ply.cast("int")))
        return j.withColumn("time_remaining_seconds", clock).drop("__secs")
    t = times.select(F.col("game_uuid").alias("__g"), F.col("username").alias("__u"), F.col("move_number").alias("__m"),
                     "time_remaining_seconds")
    return j.join(t, (F.col("game_uuid") == F.col("__g")) & (F.col("__raw_username") == F.col("__u"))
                  & (ply == F.col("__m")), "left").drop("__g", "__u", "__m")


def _ply_rows(j: DataFrame, p: Params, times: DataFrame | None = None) -> DataFrame:
    """Joined games and moves with what a ply's own row (and its clock) tells."""
    ply, side = F.col("move_number"), F.col("playing_as")
    turn = F.col("player_color_turn") == side
    return _with_clock(j, times).withColumns({
        "game_phase": fx.band_phase(ply, p.game_phases),
        "is_playing_turn": turn,
        "playing_turn_name": F.when(turn, F.lit("Playing Turn")).otherwise(F.lit("Opponent Turn")),
        "score_playing": fx.pick_by_side(side, "score_white", "score_black"),
        "win_probability_playing": fx.pick_by_side(side, "win_probability_white", "win_probability_black"),
        "position_status_playing": fx.position_status(F.col("score_playing"), p.even_limit),
    })


def _judged(j: DataFrame, p: Params) -> DataFrame:
    j = cl.classify_misses(j, p)
    return j.withColumn("miss_context_playing", cl.miss_context(F.col("miss_category_playing"),
                                                                F.col("prev_position_status_playing")))


def _massive_turn() -> Column:
    return cl.massive_blunder_turn(F.col("miss_category_playing"), F.col("miss_category_opponent"),
                                   F.col("playing_turn_name"))


def _scanned(j: DataFrame, p: Params) -> DataFrame:
    """What other plies of the game tell, by windows."""
    # Clock ÷ clock after the first ply of the same colour in the game. Every player row of a game
    # carries the same plies, so the (game, player) partition finds the same first ply as a
    # (game, colour) partition would.
    j = sq.ratio_to_first_of_group(j, "time_remaining_seconds", "player_color_turn", ("White", "Black"),
                                   GAME_KEYS, PLY_ORDER, "prct_time_remaining")
    j = sq.score_swing(j, "score_playing", GAME_KEYS, PLY_ORDER, "prev_score_playing", "variance_score_playing")
    j = sq.lag_of(j, "position_status_playing", GAME_KEYS, PLY_ORDER, "prev_position_status_playing")
    return sq.first_non_null_over(_judged(j, p), _massive_turn(), GAME_KEYS, PLY_ORDER, "first_blunder_playing_turn_name")


def _scanned_in_segments(j: DataFrame, p: Params) -> DataFrame:
    """The same by segmented scans: what does not depend on other scans first, then the first massive blunder."""
    colour, clock = F.col("player_color_turn"), F.col("time_remaining_seconds")
    cut = cut_segments(j, GAME_KEYS, PLY_ORDER)
    j = segmented_scan(cut, GAME_KEYS, PLY_ORDER, [
        Lag("prev_score_playing", F.col("score_playing")), Lag("prev_position_status_playing", F.col("position_status_playing")),
        First("__white", clock, colour == F.lit("White")), First("__black", clock, colour == F.lit("Black"))])
    j = j.withColumns({
        "variance_score_playing": F.col("score_playing") - F.col("prev_score_playing"),
        "prct_time_remaining": F.try_divide(clock, F.when(colour == F.lit("White"), F.col("__white")).otherwise(F.col("__black")))})
    return segmented_scan(_judged(j, p), GAME_KEYS, PLY_ORDER, [
        First("first_blunder_playing_turn_name", _massive_turn(), skip_nulls=True)])


# ---------------------------------------------------------------- A: two-level aggregate

AGG_DIMENSIONS = ("url", "end_time", "end_time_date", "end_time_month", "playing_rating", "playing_rating_range",
                  "opponent_rating", "opponent_rating_range", "playing_as", "playing_result", "time_class",
                  "time_control", "first_blunder_playing_turn_name")


def _measures(p: Params):
    miss = F.col("miss_category_playing")
    is_blunder = miss.isin(*cl.BLUNDERS)
    is_massive = miss == F.lit(cl.MASSIVE)
    score = F.col("score_playing")
    out = [
        F.count("move_number").alias("nb_moves"),
        F.count_if(is_blunder).alias("nb_blunder_playing"),
        F.count_if(is_massive).alias("nb_massive_blunder_playing"),
        F.count_if(score > p.should_win_mid).alias("nb_moves_above_decisive_advantage"),
        F.min(F.when(is_blunder, F.col("prct_time_remaining"))).alias("first_blunder_playing_prct_time_remaining"),
        F.min(F.when(is_massive, F.col("prct_time_remaining"))).alias(
            "first_massive_blunder_playing_prct_time_remaining"),
    ]
    # Per-phase pivot; inside grouping sets the argument sees the un-nulled phase column.
    for _, label, key in p.game_phases:
        in_phase = F.col("game_phase") == F.lit(label)
        out.append(F.count_if(in_phase & is_massive).alias(f"nb_massive_blunder_{key}_playing"))
        out.append(F.count_if(in_phase & is_blunder).alias(f"nb_blunder_{key}_playing"))
    plies = F.collect_list(F.col("massive_blunder_move_number_playing"))
    out += [
        # STRING_AGG in numeric order; NULL when the group has none.
        F.when(F.size(plies) > 0, F.array_join(F.array_sort(plies).cast("array<string>"), ", "))
         .alias("massive_blunder_move_number_playing"),
        F.count_if(F.col("miss_context_playing") == F.lit("Throw")).alias("nb_throw_playing"),
        F.count_if(F.col("miss_context_playing") == F.lit("Missed Opportunity")).alias("nb_missed_opportunity_playing"),
        # Lower-middle median (the 50th of 100 quantiles), exact and deterministic per group.
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY score_playing)").cast("bigint")
         .alias("median_score_playing"),
        F.max(score).alias("max_score_playing"),
        F.min(score).alias("min_score_playing"),
        F.stddev_samp(score).alias("std_score_playing"),
    ]
    return out


def aggregate_games(gwm: DataFrame, params: Params = Params(), with_flag: bool = True) -> DataFrame:
    """Per (player, game) and per (player, game, phase) in one grouping-sets aggregate.

    Lazy. ``has_enough_games`` counts the rows of each (player, class, month, opponent range, level
    key) in a second, narrow branch over the same rows: it needs no move-level measure, so the
    optimizer prunes the windows from it. ``with_flag=False`` leaves the flag and its branch out.
    """
    p = params
    dims = [F.any_value(F.col(c), True).alias(c) for c in AGG_DIMENSIONS]
    level_key = F.when(F.col("__g") == 1, F.lit("Recent Games")).otherwise(F.col("game_phase"))

    def levels(*measures):
        return gwm.groupingSets([["username", "game_uuid", "game_phase"], ["username", "game_uuid"]],
                                "username", "game_uuid", "game_phase").agg(F.grouping("game_phase").alias("__g"), *measures)

    agg = (levels(*dims, *_measures(p)).withColumns({
        "game_phase_key": level_key,
        "aggregation_level": F.when(F.col("__g") == 1, F.lit("Games")).otherwise(F.lit("Game Phases")),
        "max_score_playing_range": fx.max_score_range(F.col("max_score_playing"), p.should_win_low, p.should_win_mid),
        "max_score_playing_type": fx.max_score_type(F.col("max_score_playing"), p.should_win_mid),
    }).drop("__g"))
    cell = ["username", "time_class", "end_time_month", "opponent_rating_range", "game_phase_key"]
    if not with_flag:
        return agg.select(*[c for c in AGG_COLUMNS(p) if c != "has_enough_games"])
    narrow = levels(*[F.any_value(F.col(c), True).alias(c) for c in cell[1:-1]]).withColumn("game_phase_key", level_key)
    agg = count_over(agg, cell, "__n", narrow)
    agg = agg.withColumn("has_enough_games", F.col("__n") > p.min_games_played).drop("__n")
    return agg.select(*AGG_COLUMNS(p))


def with_score_sketches(agg: DataFrame, gwm: DataFrame, params: Params = Params()) -> DataFrame:
    """The aggregate with ``score_sketch`` at both levels, a mergeable sketch of the plies' scores.

    Scores are counted by bucket for both levels in one grouping-sets pass that reads four columns of the
    move grain and none of its windows. What a consumer merges (a player's games, a cell) needs no plies.
    """
    keys = ["username", "game_uuid", "game_phase"]
    scores = gwm.select(*keys, qt.bucket_of(F.col("score_playing"), params.sketch_bits).alias("bucket"))
    counted = scores.groupingSets([[*keys, "bucket"], [*keys[:2], "bucket"]], *keys, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("game_phase").alias("__g"))
    level = F.when(F.col("__g") == 1, F.lit("Games")).otherwise(F.lit("Game Phases"))
    keys.append("aggregation_level")
    made = qt.gathered(counted.withColumn("aggregation_level", level), keys, "score_sketch")
    made = made.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "score_sketch")
    same = [agg[k].eqNullSafe(made[f"__k_{k}"]) for k in keys]
    return agg.join(made, same, "left").drop(*[f"__k_{k}" for k in keys])


def AGG_COLUMNS(p: Params = Params()) -> list[str]:
    phase_cols = []
    for _, _, key in p.game_phases:
        phase_cols += [f"nb_massive_blunder_{key}_playing", f"nb_blunder_{key}_playing"]
    return (["username", "game_uuid", "game_phase", "game_phase_key", "aggregation_level", *AGG_DIMENSIONS,
             "nb_moves", "nb_blunder_playing", "nb_massive_blunder_playing", "nb_moves_above_decisive_advantage",
             "first_blunder_playing_prct_time_remaining", "first_massive_blunder_playing_prct_time_remaining",
             *phase_cols, "massive_blunder_move_number_playing", "nb_throw_playing", "nb_missed_opportunity_playing",
             "median_score_playing", "max_score_playing", "min_score_playing", "std_score_playing",
             "max_score_playing_range", "max_score_playing_type", "has_enough_games"])
