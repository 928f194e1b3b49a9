"""The staging adapter: line items are shuffled once, and repeated rows and nulls count as in the plain definition."""

import datetime as dt

from pyspark.sql import functions as F

from plyscope.sources import adapter

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def _tables(spark, path, lines, suppliers):
    spark.createDataFrame(lines, LINE).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(1, 1), (2, 2)], "n_nationkey int, n_regionkey int").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(1, "ASIA"), (2, None)], "r_regionkey int, r_name string").write.parquet(f"{path}/region.parquet")


def _line(order, supplier, day, quantity=26.0, flag="A"):
    return (order, 1, supplier, 1, quantity, 9.5, flag, "F", day and dt.datetime(1995, 3, day))


def test_plies_are_numbered_in_order_with_repeated_suppliers_and_nulls(spark, tmpdir_path):
    _tables(spark, tmpdir_path,
            [_line(3, 1, 2), _line(1, 1, 5), _line(2, 1, 2), _line(7, 4, 1), _line(7, 4, 1), _line(8, 4, None), _line(9, None, 1),
             _line(10, 99, 1), _line(5, 15, 1, flag=None), _line(6, 15, 2)],
            [(1, 1), (4, 1), (4, 1), (15, 2), (16, None)])
    games, moves = adapter.staging(spark, tmpdir_path)
    got = sorted((r.game_uuid or "", r.move_number, r.move or "") for r in moves.collect())
    want = [("g-1-1995", i, "AF") for i in (1, 2, 3)] + [("g-4-1995", i, "AF") for i in (1, 2, 3, 4)]
    want += [("", i, "AF") for i in (1, 2)]             # no ship date: a game without a year, both copies of the supplier
    want += [("g-15-1995", 1, ""), ("g-15-1995", 2, "AF")]
    assert got == sorted(want)
    rows = {(r.game_uuid, r.username): r for r in games.collect()}
    assert set(rows) == {("g-1-1995", "ASIA"), ("g-4-1995", "ASIA"), (None, "ASIA"), ("g-15-1995", None)}
    assert rows["g-1-1995", "ASIA"].end_time_integer == int(dt.datetime(1995, 3, 5, tzinfo=dt.timezone.utc).timestamp())
    assert rows["g-1-1995", "ASIA"].pgn == "1. AF {[%clk 0:59:40.5]} AF {[%clk 0:59:20.5]} 2. AF {[%clk 0:59:00.5]} "
    assert rows[None, "ASIA"].end_time_integer is None
    assert rows["g-15-1995", None].pgn == "1... AF {[%clk 0:59:20.5]} "


def test_games_and_moves_follow_from_the_items_without_a_shuffle(spark, tmpdir_path):
    _tables(spark, tmpdir_path, [_line(i, 1 + i % 5, 1 + i % 28) for i in range(60)], [(i, 1) for i in range(1, 6)])
    adapter.game_items(spark, tmpdir_path).write.parquet(f"{tmpdir_path}/items")
    items = spark.read.parquet(f"{tmpdir_path}/items")
    for made in (adapter.staging_games_from, adapter.staging_moves_from):
        df = made(items)
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert "Exchange" not in plan and df.count()
    assert items.select(F.sum(F.size("items"))).first()[0] == 60
