"""The three-key clock join: its fan-out, and its plan over co-bucketed tables."""

import uuid

from plyscope.params import Params
from plyscope.plans import intermediate as im
from plyscope.plans import reporting as rp
from plyscope.sources import bucketed

from fixtures import AS_OF, clocks_falling, game, games_df, moves_df, pgn

P = Params(as_of=AS_OF)


def _models(spark, rows, lengths):
    moves = None
    for u, n in lengths.items():
        m = moves_df(spark, u, [10 * i for i in range(n)])
        moves = m if moves is None else moves.unionByName(m)
    return im.games(games_df(spark, rows), P), im.games_moves(moves, P)


def _wide(spark, g, m, **kw):
    return rp.games_with_moves(g, m, rp.mapping_frame(spark, P), P, **kw)


ROWS = [game(uuid="once", text=pgn(clocks_falling(4))), game(uuid="twice", text=pgn(clocks_falling(3))),
        game(uuid="twice", text=pgn(clocks_falling(3, start=90))), game(uuid="twice", username="Bob", text=pgn(clocks_falling(3))),
        game(uuid="short", text=pgn(clocks_falling(1)))]
LENGTHS = {"once": 4, "twice": 3, "short": 2}


def test_a_pair_loaded_twice_fans_out(spark):
    g, m = _models(spark, ROWS, LENGTHS)
    rows = _wide(spark, g, m, times=im.games_times(g)).collect()
    of = lambda u, name, ply: sorted(r.time_remaining_seconds for r in rows if (r.game_uuid, r.username, r.move_number) == (u, name, ply))
    assert of("once", "Alice", 3) == [178.0]
    assert of("twice", "Alice", 1) == [90.0, 90.0, 180.0, 180.0]       # 2 rows of the game x 2 rows of clocks
    assert of("twice", "Bob", 1) == [180.0]                            # by the raw player name
    assert [r.time_remaining_seconds for r in rows if (r.game_uuid, r.move_number) == ("short", 2)] == [None]
    assert len(rows) == 4 + 3 * 4 + 3 + 2


def test_pairs_loaded_once_are_the_same_either_way(spark):
    g, m = _models(spark, [ROWS[0], ROWS[1], ROWS[3], ROWS[4]], LENGTHS)
    joined, read = (sorted(map(tuple, df.collect()), key=str) for df in (_wide(spark, g, m, times=im.games_times(g)), _wide(spark, g, m)))
    assert joined == read


def test_keyless_clocks_join_too(spark):
    """The hot key takes the same join in the segmented branch."""
    rows = [game(uuid="", text=pgn(clocks_falling(2))) | {"url": f"u{i}"} for i in range(2)] + [ROWS[0]]
    g, m = _models(spark, rows, {"": 2, "once": 4})
    t = im.games_times(g)
    a, b = (sorted(map(tuple, _wide(spark, g, m, times=t, segmented_keyless=k).collect()), key=str) for k in (True, False))
    assert a == b and len(a) == 2 * 2 * 2 + 4     # 2 games x 2 moves x 2 clock rows of the player's ply


def test_co_bucketed_plan_has_no_shuffle(spark, tmpdir_path):
    rows = [game(uuid=f"g{i}", text=pgn(clocks_falling(6))) for i in range(300)]
    g, m = _models(spark, rows, {f"g{i}": 6 for i in range(3)})
    names = bucketed.stage_by_game({"games": g.drop("pgn"), "moves": m, "times": im.games_times(g)}, tmpdir_path,
                                   f"t_{uuid.uuid4().hex}", 4)
    own = bucketed.co_located(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    t = {k: own.table(v) for k, v in names.items()}
    grain = t["games"].withColumnRenamed("username", "__raw_username").join(t["moves"], "game_uuid")
    for df in (rp._with_clock(grain, t["times"]),
               rp._scanned(rp._ply_rows(grain.withColumn("username", grain["__raw_username"]), P, t["times"]), P)):
        plan = own._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert df.count() == 18
    plain = spark.table(names["games"]).withColumnRenamed("username", "__raw_username").join(spark.table(names["moves"]), "game_uuid")
    assert rp._with_clock(plain, spark.table(names["times"])).count() == 18


def test_buckets_hold_one_file_each_and_no_keyless_rows(spark, tmpdir_path):
    import os
    g, m = _models(spark, [game(uuid=u) for u in ("", "a", "b", "c")], {"": 1, "a": 2})
    names = bucketed.stage_by_game({"games": g}, tmpdir_path, f"t_{uuid.uuid4().hex}", 4)
    files = [f for f in os.listdir(f"{tmpdir_path}/games") if f.endswith(".parquet")]
    assert len(files) <= 4 and spark.table(names["games"]).count() == 3


def test_derived_tables_are_shuffled_as_what_they_start_from(spark, tmpdir_path, monkeypatch):
    """Clocks and ply columns are made in the buckets: the same tables, from a shuffle without them."""
    g, _ = _models(spark, [game(uuid=f"g{i}", text=pgn(clocks_falling(6))) for i in range(9)], {"g1": 1})
    dealt, deal = [], type(g).repartition
    monkeypatch.setattr(type(g), "repartition", lambda self, *a: (dealt.append(self.columns), deal(self, *a))[1] if len(a) > 1 else deal(self, *a))
    text = g.select("username", "game_uuid", "pgn")
    names = bucketed.stage_by_game({"times": text}, tmpdir_path, f"t_{uuid.uuid4().hex}", 4, {"times": im.games_times})
    assert dealt == [["username", "game_uuid", "pgn"]]
    assert sorted(map(tuple, spark.table(names["times"]).collect())) == sorted(map(tuple, im.games_times(g).collect()))


def test_the_registered_join_shuffles_no_derived_columns(spark, monkeypatch):
    from plyscope import catalog
    given = {}
    monkeypatch.setattr(bucketed, "stage_by_game", lambda tables, *a: given.update(tables) or (_ for _ in ()).throw(KeyboardInterrupt))
    try:
        catalog.clock_join_plan(spark, "/root/testdata/sf0.001")
    except KeyboardInterrupt:
        pass
    assert given["moves"].columns == ["game_uuid", "move_number", "move", "score_white"]
    assert given["times"].columns == ["username", "game_uuid", "pgn"]
