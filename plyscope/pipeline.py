"""Build every model from the staging snapshots and write the tables.

The move-grain table is written once (partitioned by local month) and read back by the aggregate
and the sampled-curve datamart: this cuts the lineage in the shared output folder, so a lost
executor re-runs a stage of one table instead of the whole chain, and the recent-week datamart
reads only the last month partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope import schemas
from plyscope.plans import datamart as dm
from plyscope.plans import intermediate as im
from plyscope.plans import quality as qa
from plyscope.plans import reporting as rp
from plyscope.params import Params
from plyscope.sources import ingest as ig

TABLES = ("games_with_moves", "agg_games_with_moves", "agg_games_with_moves_only_games", "agg_games_benchmark",
          "games_with_moves_only_recent", "data_tests")


def register_views(spark: SparkSession, staging_games: DataFrame, staging_moves: DataFrame,
                   params: Params = Params(), mapping: DataFrame | None = None) -> dict[str, DataFrame]:
    """The lazily evaluated models, also registered as temp views for SQL users."""
    mapping = mapping if mapping is not None else rp.mapping_frame(spark, params)
    g = im.games(staging_games, params)
    m = im.games_moves(staging_moves, params)
    views = {"games": g, "games_moves": m, "games_times": im.games_times(g),
             "games_with_moves": rp.games_with_moves(g, m, mapping, params)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def run(spark: SparkSession, staging_games: DataFrame, staging_moves: DataFrame, out_dir: str,
        params: Params = Params(), mapping: DataFrame | None = None) -> dict[str, str]:
    """Write all tables under ``out_dir`` (a shared folder on a cluster); returns their paths."""
    views = register_views(spark, staging_games, staging_moves, params, mapping)
    paths = {t: f"{out_dir}/{t}" for t in TABLES}

    # one partition (or a few, where a month is large) per month, so few files
    grain = rp.games_with_moves(views["games"], views["games_moves"], mapping if mapping is not None else rp.mapping_frame(spark, params),
                                params, segmented_keyless=True)
    (grain.hint("rebalance", "end_time_month").write.mode("overwrite").partitionBy("end_time_month")
     .parquet(paths["games_with_moves"]))
    gwm = spark.read.parquet(paths["games_with_moves"])

    # Partitioned by level so the game-level datamart (P20) reads one partition.
    ig.materialize_table(rp.aggregate_games(gwm, params), paths["agg_games_with_moves"],
                         partition_by=["aggregation_level"])
    agg = spark.read.parquet(paths["agg_games_with_moves"])

    ig.materialize_table(dm.games_only(agg), paths["agg_games_with_moves_only_games"])
    ig.materialize_table(dm.benchmark(agg, params), paths["agg_games_benchmark"])
    ig.materialize_table(dm.sample_grid(gwm, params), paths["games_with_moves_only_recent"],
                         sort_within=[F.desc("end_time")])  # L1: newest games first in each file
    ig.materialize_table(qa.report(views["games"], views["games_moves"], params), paths["data_tests"])
    return paths


def run_from_snapshots(spark: SparkSession, games_root: str, moves_root: str, out_dir: str,
                       params: Params = Params()) -> dict[str, str]:
    """Entry 3 over the dated staging snapshots."""
    return run(spark, ig.read_snapshots(spark, games_root, schemas.GAMES),
               ig.read_snapshots(spark, moves_root, schemas.MOVES), out_dir, params)


def score_new_games(spark: SparkSession, games_root: str, moves_root: str, evaluator_factory,
                    load_ts: str | None = None, num_partitions: int | None = None,
                    keep_keyless: bool = True) -> str:
    """Entry 2: score every processable game that has no scored move yet and append the plies as a
    dated move snapshot (X1 → X2 → S9). Returns the snapshot suffix used."""
    from plyscope.plans.scoring import score_moves
    games = ig.read_snapshots(spark, games_root, schemas.GAMES)
    moves = ig.read_snapshots(spark, moves_root, schemas.MOVES)
    todo = ig.select_unscored_games(games, moves, keep_keyless)
    ts = load_ts or ig.load_suffix()
    ig.append_snapshot(score_moves(todo, evaluator_factory, num_partitions), moves_root, ts)
    return ts
