"""Quantile sketches against exact quantiles, their error bound and merging."""

import functools
import math
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.operators import quantiles as qt
from plyscope.params import Params
from plyscope.plans import datamart as dm
from plyscope.plans import intermediate as im
from plyscope.plans import reporting as rp

from fixtures import AS_OF, game, games_df, moves_df

QS = (0.01, 0.25, 0.5, 0.9, 1.0)
BIG = (1 << 63) - 1


def _nearest_rank(values, q):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(q * len(values))) - 1] if values else None


def _frame(spark, groups, parts=7):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v bigint").repartition(parts)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    return {
        "hot": [rng.randrange(-3000, 3000) for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * rng.randrange(1, 1 << rng.randrange(1, 63)) for _ in range(500)],
        "ties": [7] * 40 + [-7] * 40, "ends": [BIG, -BIG, -BIG - 1, 0],
        "nulls": [None, None], "some": [None, 3, None, 129, 130], "one": [-1000], None: [4, 5, 6, 1000],
    }


@pytest.mark.parametrize("bits", [1, 3, 7, 20])
def test_quantiles_are_within_the_bound(spark, groups, bits):
    got = qt.sketches(_frame(spark, groups), ["k"], F.col("v"), bits)
    rows = got.select("k", qt.total(F.col("sketch")).alias("n"), F.size("sketch").alias("size"),
                      *[qt.quantile(F.col("sketch"), q, bits).alias(f"q{i}") for i, q in enumerate(QS)]).collect()
    assert {r.k for r in rows} == set(groups)
    for r in rows:
        known = [v for v in groups[r.k] if v is not None]
        assert r.n == len(known) and r["size"] <= min(len(known), 2 ** bits * (65 - bits))
        for i, q in enumerate(QS):
            exact, near = _nearest_rank(known, q), r[f"q{i}"]
            if exact is None:
                assert near is None
            else:
                assert abs(near - exact) << bits <= abs(exact)


def test_small_numbers_are_exact(spark):
    values = list(range(-127, 128))
    got = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", qt.bucket_of(F.col("v"), 7).alias("b"))
    assert all(r.v == r.b == r.m for r in got.select("*", qt.middle_of(F.col("b"), 7).alias("m")).collect())


def test_buckets_keep_the_order(spark):
    rng = random.Random(9)
    values = sorted({rng.randrange(-BIG, BIG) >> rng.randrange(0, 63) for _ in range(800)})
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", qt.bucket_of(F.col("v"), 4).alias("b")).collect()
    buckets = [r.b for r in sorted(rows)]
    assert buckets == sorted(buckets) and len(set(buckets)) < len(buckets)


def test_merging_equals_one_sketch_of_all_rows(spark, groups):
    df = _frame(spark, groups).withColumn("part", F.pmod(F.hash("v"), F.lit(5)))
    whole = qt.sketches(df, ["k"], F.col("v"), 4)
    parts = qt.sketches(df, ["k", "part"], F.col("v"), 4)
    assert parts.count() > whole.count()
    assert parts.schema["sketch"].dataType.simpleString() == qt.SKETCH
    twice = qt.merged(qt.merged(parts.withColumn("half", F.col("part") % 2), ["k", "half"]), ["k"])
    key = lambda r: str(r.k)
    assert sorted(twice.collect(), key=key) == sorted(whole.collect(), key=key)


def test_empty_table(spark):
    none = spark.createDataFrame([], "k string, v bigint")
    made = qt.sketches(none, ["k"], F.col("v"), 7)
    assert made.count() == 0 and qt.merged(made, ["k"]).count() == 0


def test_plies_are_counted_before_the_exchange(spark, groups):
    plan = qt.sketches(_frame(spark, groups), ["k"], F.col("v"), 7)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_collect_list" in plan


def test_levels_of_the_aggregate(spark):
    """Phase sketches merge into the game's, games into the player's; a game without scores has an empty one."""
    p = Params(as_of=AS_OF, sketch_bits=3)
    rng = random.Random(3)
    scores = {f"g{i}": [rng.randrange(-900, 900) for _ in range(70)] for i in range(3)}
    scores["g3"] = [None, None]
    g = im.games(games_df(spark, [game(uuid=u) for u in scores]), p)
    m = im.games_moves(functools.reduce(DataFrame.unionByName, [moves_df(spark, u, s) for u, s in scores.items()]), p)
    gwm = rp.games_with_moves(g, m, rp.mapping_frame(spark, p), p)
    agg = rp.aggregate_games(gwm, p, with_flag=False)
    got = rp.with_score_sketches(agg, gwm, p)
    assert got.columns == [*agg.columns, "score_sketch"] and got.count() == agg.count()
    rows = {(r.game_uuid, r.game_phase): r for r in got.select(
        "*", qt.quantile(F.col("score_sketch"), 0.5, 3).alias("near"), qt.total(F.col("score_sketch")).alias("n")).collect()}
    for (uuid, phase), r in rows.items():
        if uuid == "g3":
            assert r.score_sketch == [] and r.near is None and r.median_score_playing is None
        else:
            assert r.n == r.nb_moves and abs(r.near - r.median_score_playing) * 8 <= abs(r.median_score_playing)
    phases = got.filter("aggregation_level = 'Game Phases'")
    merged = {r.game_uuid: r.score_sketch for r in qt.merged(phases, ["username", "game_uuid"], "score_sketch").collect()}
    assert merged == {u: rows[(u, None)].score_sketch for u in scores}

    top = [r for r in dm.score_quantiles(got, p).collect() if r.aggregation_level == "Games"]
    every = [r.score_playing for r in gwm.filter("score_playing is not null").collect()]
    assert len(top) == 1 and top[0].nb_scores == len(every) == 210
    for name, q in dm.SCORE_QUANTILES:
        exact = _nearest_rank(every, q)
        assert abs(top[0][name] - exact) * 8 <= abs(exact)
