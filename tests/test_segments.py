"""Segmented scans against plain windows, and how evenly a hot key is spread."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plyscope.operators.joins import grid_join
from plyscope.operators.segments import SEGMENT, First, Lag, cut_segments, segmented_scan
from plyscope.params import Params
from plyscope.plans import intermediate as im
from plyscope.plans import reporting as rp

from fixtures import AS_OF, clocks_falling, game, games_df, moves_df, pgn

def scans():
    return [Lag("prev", F.col("v")), Lag("prev_s", F.col("s")), First("first_x", F.col("v"), F.col("c") == "x"),
            First("first_known", F.col("s"), skip_nulls=True), First("first_known_y", F.col("v"), F.col("c") == "y", skip_nulls=True)]


def plain(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    box = F.struct("v")
    return df.withColumns({
        "prev": F.lag("v").over(w), "prev_s": F.lag("s").over(w),
        "first_x": F.first(F.when(F.col("c") == "x", box), ignorenulls=True).over(every)["v"],
        "first_known": F.first("s", ignorenulls=True).over(every),
        "first_known_y": F.first(F.when(F.col("c") == "y", F.col("v")), ignorenulls=True).over(every)})


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("segments", [1, 3, 16])
@pytest.mark.parametrize("seed", range(3))
def test_scans_equal_plain_windows(spark, segments, seed):
    """Hot, small and NULL keys; NULL values at borders; sequences of NULLs only; two order columns."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        k = rng.choice(["hot"] * 6 + ["a", "b", None, f"k{i}"])
        v = rng.choice([None, rng.randrange(9)]) if k != "a" else None
        rows.append((k, rng.randrange(2), rng.choice([None, rng.randrange(40)]), i, v, rng.choice([None, "p", "q"]), rng.choice("xyz")))
    df = spark.createDataFrame(rows, "k string, k2 int, o int, i int, v int, s string, c string")
    keys, order = ["k", "k2"], ["o", "i"]
    got = segmented_scan(cut_segments(df, keys, order, segments), keys, order, scans()).drop(SEGMENT)
    assert got.columns == [*df.columns, *[s.out for s in scans()]]
    assert _rows(got) == _rows(plain(df, keys, order))


def test_a_second_scan_on_the_same_cut(spark):
    """A scan over a column that an earlier scan made."""
    df = spark.range(500).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("i"), (F.col("id") * 7919 % 101).cast("int").alias("v"))
    cut = cut_segments(df, ["k"], ["i"], 8)
    one = segmented_scan(cut, ["k"], ["i"], [Lag("prev", F.col("v"))]).withColumn("rise", F.col("v") > F.col("prev") + 40)
    two = segmented_scan(one, ["k"], ["i"], [First("at", F.when(F.col("rise"), F.col("i")), skip_nulls=True)])
    values = [i * 7919 % 101 for i in range(500)]
    want = next(i for i in range(1, 500) if values[i] > values[i - 1] + 40)
    assert two.select("at").distinct().collect() == [(want,)]


def test_a_hot_key_is_spread_over_the_segments(spark):
    df = spark.range(20_000).select(F.lit("").alias("k"), "id")
    sizes = [r["count"] for r in cut_segments(df, ["k"], ["id"], 10).groupBy(SEGMENT).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, k2 int, o int, i int, v int, s string, c string")
    assert segmented_scan(cut_segments(df, ["k", "k2"], ["o", "i"], 4), ["k", "k2"], ["o", "i"], scans()).count() == 0


def test_grid_join_gives_all_pairs_evenly(spark):
    a, b = spark.range(90).withColumnRenamed("id", "x"), spark.range(70).withColumnRenamed("id", "y")
    got = grid_join(a, b, 9)
    assert got.count() == got.distinct().count() == 90 * 70
    assert grid_join(a, b.limit(0), 9).count() == 0


def test_keyless_games_in_segments_equal_the_lazy_model(spark):
    rng = random.Random(1)
    p = Params(as_of=AS_OF)
    rows = [game(uuid="", text=pgn(clocks_falling(30))) | {"url": f"https://x/game/{i}"} for i in range(6)]
    rows += [game(uuid="", username="Bob", text=pgn(clocks_falling(9))), game(uuid="g1"), game(uuid="g2", username="Bob")]
    moves = None
    for u, n in [("", 30), ("", 25), ("g1", 8), ("g2", 5)]:
        m = moves_df(spark, u, [rng.randrange(-900, 900) for _ in range(n)])
        moves = m if moves is None else moves.unionByName(m)
    g, m = im.games(games_df(spark, rows), p), im.games_moves(moves, p)
    lazy = rp.games_with_moves(g, m, rp.mapping_frame(spark, p), p)
    cut = rp.games_with_moves(g, m, rp.mapping_frame(spark, p), p, segmented_keyless=True)
    assert lazy.count() == 7 * 55 + 13 and cut.columns == lazy.columns
    assert _rows(cut) == _rows(lazy)
    assert cut.filter("game_uuid = '' and first_blunder_playing_turn_name is not null").count() > 0
    p = p.with_(keep_keyless=False)
    assert rp.games_with_moves(g, m, rp.mapping_frame(spark, p), p, segmented_keyless=True).count() == 13
