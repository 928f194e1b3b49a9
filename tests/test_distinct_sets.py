"""Distinct sets as bitmaps against plain distinct counts; the audit from stored sets against its pass."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from plyscope.operators import distinct_sets as ds
from plyscope.params import Params
from plyscope.plans import datamart as dm

from fixtures import AS_OF

P = Params(as_of=AS_OF)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def visits(spark):
    """Members in several cells; one cell with most rows; more members than two blocks hold; NULLs."""
    near = spark.range(80_000).select(F.lit("hot").alias("cell"), F.concat(F.lit("m"), F.col("id")).alias("m"), (F.col("id") % 3).alias("x"))
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, f"m{rng.randrange(300)}"]), rng.randrange(3)) for _ in range(2000)]
    return near.unionByName(spark.createDataFrame(rows, "cell string, m string, x bigint"))


def test_numbers_are_distinct_and_stay(spark, visits, tmpdir_path):
    got = ds.numbered_members(visits, "m", ["cell"], f"{tmpdir_path}/n")
    first = _rows(got)
    assert first == _rows(got) and len({n for _, n in first}) == len(first) == visits.select("m").na.drop().distinct().count()
    assert min(n for _, n in first) >= 1


def test_unions_equal_distinct_counts(spark, visits, tmpdir_path):
    numbers = ds.numbered_members(visits, "m", ["cell"], f"{tmpdir_path}/n")
    sets = ds.member_sets(visits.join(numbers, "m", "left"), ["cell", "x"], "number", {"every": F.lit(True), "odd": F.col("x") == 1})
    sets.write.parquet(f"{tmpdir_path}/s")
    stored = spark.read.parquet(f"{tmpdir_path}/s")
    assert stored.count() < 60
    odd = F.count_distinct(F.when(F.col("x") == 1, F.col("m")))
    got = ds.union_sizes(stored, ["cell"], {"n": "every", "n_odd": "odd"})
    assert _rows(got) == _rows(visits.groupBy("cell").agg(F.count_distinct("m"), odd))
    whole = ds.union_sizes(stored.withColumn("one", F.lit(1)), ["one"], {"n": "every", "n_odd": "odd"})
    assert _rows(whole.drop("one")) == _rows(visits.agg(F.count_distinct("m"), odd))


def test_unions_are_combined_before_the_exchange(spark, visits, tmpdir_path):
    numbers = ds.numbered_members(visits, "m", ["cell"], f"{tmpdir_path}/n")
    sets = ds.member_sets(visits.join(numbers, "m"), ["cell"], "number", {"every": F.lit(True)})
    plan = ds.union_sizes(sets, ["cell"], {"n": "every"})._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "partial_bitmap_or_agg" in plan


def _grain(spark, n_games, seed):
    """Rows as the move grain gives them: two or three players a game, several plies each."""
    rng, rows = random.Random(seed), []
    misses = [None, "Mistake", "Blunder", "Massive Blunder"]
    for i in range(n_games):
        tclass, month = rng.choice(["blitz", "rapid"]), rng.choice(["2024-06", "2024-12", "2025-01", "2025-03"])
        for user in rng.sample(["A", "B", "C", None], rng.randrange(1, 4)):
            own, other = rng.choice(["r1", "r2"]), rng.choice(["r1", "r2"])
            rows += [(f"g{i}", user, tclass, own, other, month, rng.choice(misses)) for _ in range(rng.randrange(1, 4))]
    return spark.createDataFrame(rows, "game_uuid string, username string, time_class string, playing_rating_range string, "
                                 "opponent_rating_range string, end_time_month string, miss_category_playing string"
                                 ).withColumn("end_time_date", F.to_date(F.concat("end_time_month", F.lit("-15"))))


@pytest.mark.parametrize("n_games", [0, 1, 120])
def test_audit_from_sets_equals_the_pass_over_the_plies(spark, tmpdir_path, n_games):
    gwm = _grain(spark, n_games, 7)
    sets = dm.audit_sets(gwm, f"{tmpdir_path}/n")
    sets.write.parquet(f"{tmpdir_path}/s")
    stored, massive = spark.read.schema(sets.schema).parquet(f"{tmpdir_path}/s"), 0
    for user, tclass, rng in itertools.product(["A", "nobody"], ["blitz", "rapid"], ["r1"]):
        want = _rows(dm.audit_blunder_rates(gwm, user, tclass, rng, P))
        assert _rows(dm.audit_from_sets(stored, user, tclass, rng, P)) == want
        massive += sum(r[3] for r in want)
    assert (massive > 0) == (n_games > 1)
    assert dm.audit_from_sets(stored, "A", "blitz", "r1", P).columns == list(dm.AUDIT_COLUMNS)
