import pytest
import datetime as dt

from pyspark.sql import functions as F

from plyscope.functions import core as fx
from plyscope.params import Params

from fixtures import epoch

P = Params()


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_band_phase_edges(spark):
    out = _one(spark, [(x,) for x in (1, 15, 16, 35, 36, 65, 66, None)], "n bigint",
               fx.band_phase(F.col("n"), P.game_phases))
    assert out == ["1-Early Game", "1-Early Game", "2-Mid Game", "2-Mid Game", "3-Late Game", "3-Late Game",
                   "4-Very Late Game", "4-Very Late Game"]


def test_band_rating_edges(spark):
    out = _one(spark, [(x,) for x in (0, 399, 400, 1799, 1800, None)], "r bigint",
               fx.band_rating(F.col("r"), P.rating_edges))
    assert out == ["0000-0400", "0000-0400", "0400-0600", "1600-1800", "1800+", "1800+"]


def test_rating_labels_generated_from_edges():
    assert fx.rating_band_labels((400, 600))[1] == (600, "0400-0600")
    assert fx.rating_band_labels((50,))[0] == (50, "0000-0050")


def test_position_status(spark):
    out = _one(spark, [(x,) for x in (-151, -150, 150, 151, 0, None)], "s bigint",
               fx.position_status(F.col("s"), 150))
    assert out == ["Disadvantage", "Even", "Even", "Advantage", "Even", None]


def test_simplify_result(spark):
    codes = ["checkmated", "resigned", "abandoned", "timeout", "win", "stalemate", "repetition", "agreed",
             "timevsinsufficient", "insufficient", "50move", "kingofthehill", None]
    out = _one(spark, [(c,) for c in codes], "c string", fx.simplify_result(F.col("c")))
    assert out == ["Lose"] * 4 + ["Win"] + ["Draw"] * 6 + [None, None]


def test_orient_side(spark):
    rows = [("Alice", "alice", "bob"), ("BOB", "alice", "bob"), ("carol", "alice", "bob"), ("x", "x", "x")]
    out = _one(spark, rows, "u string, w string, b string", fx.orient_side("u", "w", "b"))
    assert out == ["White", "Black", None, "White"]


def test_clock_to_seconds(spark):
    marks = ["{[%clk 0:02:59.9]}", "{[%clk 0:02:58]}", "{[%clk 1:00:00]}", "{[%clk 335:59:58]}", "{[%clk ]}", None]
    out = _one(spark, [(m,) for m in marks], "m string", fx.clock_to_seconds(F.col("m")))
    assert out[0] == 179.9
    assert out[1] == 178.0
    assert out[2] == 3600.0
    assert out[3] == 33 * 3600 + 59 * 60 + 58  # hours take at most two digits (kept as in the reference)
    assert out[4] is None and out[5] is None


def test_clock_marks_and_array(spark):
    text = "[Event \"x\"] 1. e4 {[%clk 0:02:59.9]} 1... e5 {[%clk 0:02:58]} 2. Nf3 {[%clk 0:02:57.1]} 1-0"
    df = spark.createDataFrame([(text,), ("",)], "pgn string")
    marks, secs = zip(*[(r[0], r[1]) for r in df.select(fx.clock_marks(), fx.clock_seconds_array()).collect()])
    assert marks[0] == ["{[%clk 0:02:59.9]}", "{[%clk 0:02:58]}", "{[%clk 0:02:57.1]}"]
    assert secs[0] == [179.9, 178.0, 177.1]
    assert marks[1] == [] and secs[1] == []


def test_local_datetime_dst(spark):
    # 2025-03-30 01:00 UTC is 03:00 in Paris (summer time starts at 02:00 local);
    # 2024-10-27 01:00 UTC is 02:00 in Paris (winter time from 03:00 local back to 02:00).
    rows = [(epoch(2025, 3, 30, 0, 59),), (epoch(2025, 3, 30, 1, 0),), (epoch(2024, 10, 27, 0, 59),),
            (epoch(2024, 10, 27, 1, 0),), (epoch(2025, 1, 31, 23, 30),)]
    df = spark.createDataFrame(rows, "t bigint").select(fx.local_datetime("t").alias("d"))
    got = [r[0] for r in df.select("d").collect()]
    assert got == [dt.datetime(2025, 3, 30, 1, 59), dt.datetime(2025, 3, 30, 3, 0), dt.datetime(2024, 10, 27, 2, 59),
                   dt.datetime(2024, 10, 27, 2, 0), dt.datetime(2025, 2, 1, 0, 30)]
    months = [r[0] for r in df.select(fx.local_month(F.col("d"))).collect()]
    assert months[-1] == "2025-02"  # last UTC hour of January is February in Paris


def test_local_datetime_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = spark.createDataFrame([(epoch(2025, 3, 30, 1, 0),)], "t bigint") \
                   .select(fx.local_datetime("t")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2025, 3, 30, 3, 0)


def test_windows_start(spark):
    row = spark.range(1).select(fx.month_window_start(dt.date(2025, 3, 31), 5).alias("m"),
                                fx.week_window_start(dt.date(2025, 3, 30), 1).alias("w"),
                                fx.week_window_start(dt.date(2025, 3, 31), 1).alias("w2")).collect()[0]
    assert row.m == dt.date(2024, 10, 1)
    assert row.w == dt.date(2025, 3, 17)   # Sunday → Monday of the previous ISO week
    assert row.w2 == dt.date(2025, 3, 24)


def test_win_probability(spark):
    out = _one(spark, [(0,), (400,)], "s bigint", fx.win_probability(F.col("s")))
    assert out[0] == 0.5
    assert abs(out[1] - 1 / (1 + 2.718281828459045 ** (-1.6))) < 1e-12


def test_max_score_bands(spark):
    rows = [(x,) for x in (299, 300, 499, 500, 501, None)]
    rng = _one(spark, rows, "m bigint", fx.max_score_range(F.col("m"), 300, 500))
    typ = _one(spark, rows, "m bigint", fx.max_score_type(F.col("m"), 500))
    assert rng == ["0-300", "300-500", "300-500", "500+", "500+", "500+"]
    assert typ == ["No decisive advantage"] * 4 + ["Decisive advantage", "No decisive advantage"]


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Europe/Paris"])
def test_local_time_in_the_session_zones_repeated_hour(spark, zone):
    """Two instants an hour apart that share a wall clock in New York (2024-11-03 01:30)."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(1730611800,), (1730615400,), (-1,)], "t bigint").select(
            "t", fx.local_datetime("t").cast("string").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {r.t: r.d for r in rows} == {1730611800: "2024-11-03 06:30:00", 1730615400: "2024-11-03 07:30:00",
                                        -1: "1970-01-01 00:59:59"}
