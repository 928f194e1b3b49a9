"""Datamarts: game-level subset (O), player-vs-cohort benchmark (B), sampled score curves (R), audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyscope.functions import core as fx
from plyscope.operators import classify as cl
from plyscope.operators import quantiles as qt
from plyscope.operators import distinct_sets as ds
from plyscope.operators.cohort import indicator_counts, with_others
from plyscope.params import Params


def games_only(agg: DataFrame) -> DataFrame:
    """The game-level rows of the two-level aggregate (a filter pushed to the table scan)."""
    return agg.filter(F.col("aggregation_level") == F.lit("Games"))


RATE_NAMES = ("rate_nb_blunder_playing", "rate_nb_massive_blunder_playing",
              "rate_nb_massive_blunder_playing_prct_time_50", "rate_nb_massive_blunder_playing_prct_time_70",
              "rate_nb_massive_blunder_playing_prct_time_90", "rate_nb_throw_playing",
              "rate_nb_missed_opportunity_playing")
BENCH_KEYS = ("username", "time_class", "playing_rating_range", "game_phase_key", "aggregation_level")


def _indicators(p: Params) -> dict:
    ratio = F.col("first_massive_blunder_playing_prct_time_remaining")
    ind = {
        "rate_nb_blunder_playing": F.col("nb_blunder_playing") > 0,
        "rate_nb_massive_blunder_playing": F.col("nb_massive_blunder_playing") > 0,
    }
    for t, name in zip(p.clock_thresholds, RATE_NAMES[2:5]):
        ind[name] = ratio > t
    ind["rate_nb_throw_playing"] = F.col("nb_throw_playing") > 0
    ind["rate_nb_missed_opportunity_playing"] = F.col("nb_missed_opportunity_playing") > 0
    return ind


def _rates(counts: DataFrame, total: str, prefix: str = "") -> DataFrame:
    return counts.withColumns({f"{prefix}{n}": F.try_divide(F.col(n).cast("double"), F.col(total).cast("double"))
                               for n in RATE_NAMES})


def _equal_level(agg: DataFrame) -> DataFrame:
    return agg.filter(F.col("playing_rating_range") == F.col("opponent_rating_range"))


def _recent(p: Params):
    return F.col("end_time_date") >= fx.month_window_start(p.as_of, p.benchmark_window_months)


def player_rates(agg: DataFrame, params: Params = Params()) -> DataFrame:
    """Per player × class × own range × level key, rates over recent equal-level games (> N)."""
    p = params
    counts = indicator_counts(_equal_level(agg).filter(_recent(p)), BENCH_KEYS, _indicators(p), "nb_games")
    counts = counts.filter(F.col("nb_games") > p.min_games_played)
    return _rates(counts, "nb_games").select(*BENCH_KEYS, *RATE_NAMES, "nb_games")


def average_median(agg: DataFrame, params: Params = Params()) -> DataFrame:
    """Per player × class × own range × level key, the mean of the games' median scores (recent
    equal-level games)."""
    return _equal_level(agg).filter(_recent(params)).groupBy(*BENCH_KEYS).agg(
        F.avg("median_score_playing").alias("avg_median_score_playing"))


SCORE_QUANTILES = (("score_p25", 0.25), ("score_p50", 0.5), ("score_p75", 0.75))


def score_quantiles(sketched: DataFrame, params: Params = Params()) -> DataFrame:
    """D19 above the game: per player × class × own range × level key, quartiles of the scores of all
    plies (recent equal-level games), from the merged sketches of the aggregate's rows."""
    one = qt.merged(_equal_level(sketched).filter(_recent(params)), BENCH_KEYS, "score_sketch")
    sketch = F.col("score_sketch")
    return one.select(*BENCH_KEYS, qt.total(sketch).alias("nb_scores"),
                      *[qt.quantile(sketch, q, params.sketch_bits).alias(name) for name, q in SCORE_QUANTILES])


def cohort_benchmark(agg: DataFrame, params: Params = Params()) -> DataFrame:
    """Each player's rates next to the same rates over all other players of the cell
    (class, range, level key; every loaded date), kept when the cohort has > N games.

    One pass over the aggregate gives each player's recent counts and all-time counts; the latter,
    rolled up per cell minus the player's own, are the cohort's."""
    p = params
    ind, recent = _indicators(p), _recent(p)
    bench = [f"bench_{n}" for n in RATE_NAMES] + ["bench_nb_games"]
    per = (_equal_level(agg).groupBy(*BENCH_KEYS)
           .agg(F.count_if(recent).alias("nb_games"), *[F.count_if(recent & c).alias(n) for n, c in ind.items()],
                F.count(F.lit(1)).alias("bench_nb_games"), *[F.count_if(c).alias(f"bench_{n}") for n, c in ind.items()]))
    both = with_others(per, "username", ["time_class", "playing_rating_range", "game_phase_key"], bench)
    both = both.filter((F.col("nb_games") > p.min_games_played) & (F.col("bench_nb_games") > p.min_games_played))
    both = _rates(both, "nb_games").withColumns({
        f"bench_{n}": F.try_divide(F.col(f"bench_{n}").cast("double"), F.col("bench_nb_games").cast("double"))
        for n in RATE_NAMES})
    return both.select(*BENCH_COLUMNS)


BENCH_COLUMNS = ("username", "game_phase_key", "time_class", "playing_rating_range", "aggregation_level",
                 *RATE_NAMES, "nb_games", *[f"bench_{n}" for n in RATE_NAMES], "bench_nb_games")


def most_frequent_range(bench: DataFrame) -> DataFrame:
    """M33 (first half): per player × class, the range with most games at game level; on a tie the
    larger range label wins (deterministic)."""
    return (bench.filter(F.col("aggregation_level") == F.lit("Games"))
            .groupBy("username", "time_class")
            .agg(F.max_by("playing_rating_range", F.struct("nb_games", "playing_rating_range"))
                 .alias("most_relevant_playing_rating_range"),
                 F.sum("nb_games").alias("nb_games")))


def benchmark(agg: DataFrame, params: Params = Params()) -> DataFrame:
    """The benchmark datamart, restricted to each player's most frequent range.

    The favourite is found on the benchmark's own rows: a window per (player, class), which holds at
    most ranges × level keys rows."""
    of_player = Window.partitionBy("username", "time_class")
    games = F.when(F.col("aggregation_level") == F.lit("Games"), F.struct("nb_games", "playing_rating_range"))
    b = cohort_benchmark(agg, params).withColumn("__top", F.max(games).over(of_player))
    return b.filter(F.col("playing_rating_range") == F.col("__top.playing_rating_range")).select(*BENCH_COLUMNS)


def recent_games_filter(params: Params = Params()):
    """Game-level predicate of the recent-week datamart, to prune games before the move grain."""
    return F.col("end_time_date") >= fx.week_window_start(params.as_of, params.recent_window_weeks)


def audit_games_filter(time_class: str, rating_range: str):
    """Game-level predicate of the audit (class, equal ranges, one range)."""
    return ((F.col("time_class") == time_class) & (F.col("playing_rating_range") == F.col("opponent_rating_range"))
            & (F.col("playing_rating_range") == rating_range))


RECENT_COLUMNS = ("game_uuid", "username", "time_class", "playing_result", "opponent_rating_range", "url",
                  "end_time", "playing_as", "move_number", "score_playing")


def sample_grid(gwm: DataFrame, params: Params = Params()) -> DataFrame:
    """For each recent (player, game), one row per grid ply with the score at that ply, or else
    the last score found on the grid of that game.

    One grouped pass per game replaces the reference's self-join: the grid plies' scores are
    collected while aggregating the game (≤ grid size entries), then the grid is exploded and each
    point reads its sample(s); a point with several rows (duplicate plies) yields several rows,
    as the join would.
    """
    p = params
    start = fx.week_window_start(p.as_of, p.recent_window_weeks)
    recent = F.col("end_time_date") >= start
    if "end_time_month" in gwm.columns:  # redundant month bound: prunes month partitions of a stored table
        recent = recent & (F.col("end_time_month") >= F.date_format(start, "yyyy-MM"))
    grid = F.array(*[F.lit(int(x)).cast("bigint") for x in p.sample_grid])
    on_grid = F.col("move_number").isin(*[int(x) for x in p.sample_grid])
    dims = ["time_class", "playing_result", "opponent_rating_range", "url", "end_time", "playing_as"]
    g = (gwm.filter(recent)
         .groupBy("game_uuid", "username")
         .agg(*[F.any_value(F.col(c), True).alias(c) for c in dims],
              F.collect_list(F.when(on_grid, F.struct(F.col("move_number").alias("ply"),
                                                       F.col("score_playing").alias("score"))))
              .alias("__samples")))
    known = F.filter(F.array_sort(F.col("__samples")), lambda s: s["score"].isNotNull())
    g = g.withColumn("__last", F.when(F.size(known) > 0, F.element_at(known, -1)["score"]))
    pts = g.select("*", F.explode(grid).alias("move_number"))
    pts = pts.select("*", F.explode_outer(F.filter("__samples", lambda s: s["ply"] == F.col("move_number")))
                     .alias("__hit"))
    return pts.withColumn("score_playing", F.coalesce(F.col("__hit")["score"], F.col("__last"))) \
              .select(*RECENT_COLUMNS)


AUDIT_COLUMNS = ("population", "nb_games", "nb_games_blunder", "nb_games_massive_blunder", "rate_blunder",
                 "rate_massive_blunder")


def audit_blunder_rates(gwm: DataFrame, username: str, time_class: str, rating_range: str,
                        params: Params = Params()) -> DataFrame:
    """Distinct games, games with a blunder / massive blunder and their rates, for one player
    (recent window) and for everyone else (all dates), on equal-level games of one class and range.

    One pass over the move grain: each row is tagged with its population, each game becomes one row
    with its two flags (which reuses the game partitioning), and the flags are counted; a two-row
    frame keeps an empty population's zero row, as two global aggregates would.
    """
    p = params
    miss = F.col("miss_category_playing")
    user = F.col("username")
    population = (F.when((user == username) & _recent(p), F.lit("username"))
                   .when(user != username, F.lit("benchmark")))
    base = gwm.filter(audit_games_filter(time_class, rating_range)).withColumn("population", population) \
              .filter(F.col("population").isNotNull())
    per_game = base.groupBy("game_uuid", "population").agg(
        F.bool_or(miss.isin(*cl.BLUNDERS)).alias("blunder"), F.bool_or(miss == F.lit(cl.MASSIVE)).alias("massive"))
    counts = per_game.groupBy("population").agg(
        F.count("game_uuid").alias("nb_games"), F.count_if("blunder").alias("nb_games_blunder"),
        F.count_if("massive").alias("nb_games_massive_blunder"))
    return _audit_rates(counts)


def _audit_rates(counts: DataFrame) -> DataFrame:
    """Both populations with their rates; one without games has zero counts and NULL rates."""
    both = counts.sparkSession.createDataFrame([("username",), ("benchmark",)], "population string")
    out = both.join(counts, "population", "left")
    z = F.lit(0).cast("bigint")
    out = out.select("population", *[F.coalesce(F.col(c), z).alias(c)
                                      for c in ("nb_games", "nb_games_blunder", "nb_games_massive_blunder")])
    return out.select("*",
                      F.try_divide(F.col("nb_games_blunder").cast("double"), F.col("nb_games").cast("double"))
                      .alias("rate_blunder"),
                      F.try_divide(F.col("nb_games_massive_blunder").cast("double"), F.col("nb_games").cast("double"))
                      .alias("rate_massive_blunder")).select(*AUDIT_COLUMNS)


AUDIT_CELL = ("time_class", "playing_rating_range", "end_time_month", "username")


def audit_sets(gwm: DataFrame, path: str) -> DataFrame:
    """Per player, class, range and month, the sets of equal-level games, of those with a blunder and
    of those with a massive blunder. Stored, they answer any audit without the move grain; the sets of
    new months or games are further rows. Game numbers are written to ``path``."""
    equal = _equal_level(gwm).filter(F.col("username").isNotNull())
    miss = F.col("miss_category_playing")
    games = equal.groupBy("game_uuid", *AUDIT_CELL).agg(
        F.bool_or(miss.isin(*cl.BLUNDERS)).alias("blunder"), F.bool_or(miss == F.lit(cl.MASSIVE)).alias("massive"))
    numbers = ds.numbered_members(equal.select("game_uuid", *AUDIT_CELL), "game_uuid", AUDIT_CELL, path)
    return ds.member_sets(games.join(numbers, "game_uuid"), AUDIT_CELL, "number", {
        "games": F.lit(True), "games_blunder": F.col("blunder"), "games_massive_blunder": F.col("massive")})


def audit_from_sets(sets: DataFrame, username: str, time_class: str, rating_range: str,
                    params: Params = Params()) -> DataFrame:
    """The audit of ``audit_blunder_rates`` as unions of stored sets. The recent window begins with a month,
    so months select its games exactly; a game that two others played counts once, as there."""
    p = params
    user, since = F.col("username"), F.date_format(fx.month_window_start(p.as_of, p.benchmark_window_months), "yyyy-MM")
    population = F.when((user == username) & (F.col("end_time_month") >= since), F.lit("username")).when(
        user != username, F.lit("benchmark"))
    cells = sets.filter((F.col("time_class") == time_class) & (F.col("playing_rating_range") == rating_range))
    cells = cells.withColumn("population", population).filter(F.col("population").isNotNull())
    return _audit_rates(ds.union_sizes(cells, ["population"], {f"nb_{c}": c for c in ("games", "games_blunder", "games_massive_blunder")}))
