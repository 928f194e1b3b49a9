"""Data tests with seeded faults, incremental ingest cases, scoring hook and the streaming load."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from plyscope import schemas
from plyscope.params import Params
from plyscope.plans import intermediate as im
from plyscope.plans import quality as qa
from plyscope.plans import scoring as sc
from plyscope.sources import ingest as ig

from fixtures import AS_OF, clocks_falling, epoch, game, games_df, moves_df, pgn

P = Params(as_of=AS_OF)


# ---------------------------------------------------------------- quality (K1–K4)

def _faulty(spark):
    rows = [game(uuid="ok", text=pgn(clocks_falling(4))),
            game(uuid="missing", text=pgn(clocks_falling(4))),
            game(uuid="dup", text=pgn(clocks_falling(2))),
            game(uuid="unscored", text=pgn(clocks_falling(2))),
            game(uuid="norating", w_rating=None, text=pgn(clocks_falling(2)))]
    moves = (moves_df(spark, "ok", [0, 0, 0, 0])
             .unionByName(moves_df(spark, "missing", [0, 0, 0]))            # last ply row missing
             .unionByName(moves_df(spark, "dup", [0, 0]))
             .unionByName(moves_df(spark, "dup", [0, 0]))                   # duplicated rows
             .unionByName(moves_df(spark, "norating", [0, 0]))
             .unionByName(spark.createDataFrame([("orphan", 1, "m", None)], schemas.MOVES)))
    return im.games(games_df(spark, rows), P), im.games_moves(moves, P)


def test_not_null(spark):
    g, m = _faulty(spark)
    got = {(r.model, r.column_name): r.failures for r in qa.not_null_report(g, m).collect()}
    assert got[("games", "playing_rating")] == 1
    assert got[("games_moves", "score_white")] == 1
    assert got[("games", "game_uuid")] == 0


def test_move_number_consistency(spark):
    g, m = _faulty(spark)
    got = {r.game_uuid: r for r in qa.move_number_consistency(g, m).collect()}
    assert set(got) == {"missing"}
    assert (got["missing"].max_move_number_times, got["missing"].max_move_number_moves) == (4, 3)


def test_processing_completeness(spark):
    g, m = _faulty(spark)
    got = {r.game_uuid: (r.nb_moves, r.nb_move_p1, r.nb_move_p2) for r in qa.processing_completeness(g, m).collect()}
    assert got == {"missing": (3, 2, 2), "dup": (4, 1, 1), "unscored": (None, 1, 1)}


@pytest.mark.parametrize("failures,status", [(0, "pass"), (1, "pass"), (2, "warn"), (10, "warn"), (11, "error")])
def test_severity(spark, failures, status):
    assert spark.range(1).select(qa.severity(F.lit(failures), P)).collect()[0][0] == status


def test_report(spark):
    g, m = _faulty(spark)
    got = {r.check_name: (r.failures, r.status) for r in qa.report(g, m, P).collect()}
    assert got["assert_stockfish_processing"] == (3, "warn")
    assert got["assert_move_number_consistency"] == (1, "pass")
    assert len(got) == 13
    assert got["keyless_games"] == (0, "pass")


def test_keyless_rows_are_counted(spark):
    g = im.games(games_df(spark, [game(uuid=""), game(uuid="k")]), P)
    m = im.games_moves(moves_df(spark, "", [0, 0, 0]), P)
    assert {r.model: r.failures for r in qa.keyless(g, m).collect()} == {"games": 1, "games_moves": 3}


# ---------------------------------------------------------------- ingest

ARCH = [f"https://api.example.invalid/pub/player/test_user/games/{m}"
        for m in ("2024/09", "2024/10", "2024/11", "2024/12", "2025/01", "2025/02")]


@pytest.mark.parametrize("min_archive,latest,expected", [
    (None, None, ARCH),
    ("2024/10", None, ARCH[1:]),
    ("2024/10", "2024/11", ARCH[2:]),
    ("2024/10", "2025/01", ARCH[4:]),
    ("2024/10", "2025/03", []),
])
def test_archive_filter_cases(spark, min_archive, latest, expected):
    archives = spark.createDataFrame([("test_user", a) for a in ARCH], schemas.ARCHIVE_LIST)
    hist_rows = [] if latest is None else [
        ("test_user", f"https://api.example.invalid/pub/player/test_user/games/{latest}", 0)]
    history = spark.createDataFrame(hist_rows, schemas.HISTORY)
    out = ig.filter_archives_by_min_month(ig.filter_archives_by_history(archives, history), min_archive)
    assert sorted(r.archive_url for r in out.collect()) == expected


def test_archive_filter_other_player_history(spark):
    archives = spark.createDataFrame([("test_user", a) for a in ARCH], schemas.ARCHIVE_LIST)
    history = spark.createDataFrame([("someone", ARCH[-1], 5)], schemas.HISTORY)
    assert ig.filter_archives_by_history(archives, history).count() == len(ARCH)


def test_filter_new_games_strict(spark):
    rows = [game(uuid="a", end=100), game(uuid="b", end=200), game(uuid="c", end=201), game(uuid="z", end=0)]
    history = spark.createDataFrame([("Alice", "x", 200)], schemas.HISTORY)
    kept = sorted(r.game_uuid for r in ig.filter_new_games(games_df(spark, rows), history).collect())
    assert kept == ["c"]
    none = spark.createDataFrame([], schemas.HISTORY)
    assert sorted(r.game_uuid for r in ig.filter_new_games(games_df(spark, rows), none).collect()) == ["a", "b", "c"]


def _land(tmp, user, month, games):
    import json
    d = os.path.join(tmp, f"username={user}", f"archive={month}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{uuid.uuid4().hex}.json"), "w") as f:
        json.dump({"games": games}, f)


def _api_game(u, end, white="alice", rating=1000):
    return {"url": f"https://x/{u}", "pgn": pgn(clocks_falling(2)), "time_control": "180", "end_time": end,
            "rated": True, "uuid": u, "time_class": "blitz", "rules": "chess",
            "white": {"username": white, "rating": rating, "result": "win", "@id": "w", "uuid": "wu"},
            "black": {"username": "bob", "result": "checkmated"}}


def test_flatten_and_load_twice(spark, tmpdir_path):
    landing, root = f"{tmpdir_path}/landing", f"{tmpdir_path}/games"
    _land(landing, "alice", "2025-02", [_api_game("g1", 100), _api_game("g2", 200)])
    _land(landing, "alice", "2025-03", [_api_game("g3", 300)])
    p = P.with_(min_archive="2025/02")
    ig.load_games(spark, landing, root, p, now=dt.datetime(2025, 3, 31, 6, 0))
    g = ig.read_snapshots(spark, root, schemas.GAMES)
    rows = {r.game_uuid: r for r in g.collect()}
    assert set(rows) == {"g1", "g2", "g3"}
    assert rows["g1"].black_rating is None and rows["g1"].black_id == "" and rows["g1"].initial_setup == ""
    assert rows["g1"].archive_url.endswith("alice/games/2025/02") and rows["g3"].load_ts == "20250331_0600"
    assert rows["g1"].white_id == "w" and rows["g1"].bq_load_date == "2025-03-31 06:00:00"
    # same files again, next day: the latest month is re-read, but no game is newer than the mark
    ig.load_games(spark, landing, root, p, now=dt.datetime(2025, 4, 1, 6, 0))
    assert ig.read_snapshots(spark, root, schemas.GAMES).count() == 3
    assert not os.path.exists(f"{root}/load_ts=20250401_0600")   # empty batch → no snapshot written
    # a new game in the latest month is picked up
    _land(landing, "alice", "2025-03", [_api_game("g4", 400)])
    ig.load_games(spark, landing, root, p, now=dt.datetime(2025, 4, 2, 6, 0))
    assert sorted(r.game_uuid for r in ig.read_snapshots(spark, root, schemas.GAMES)
                  .filter("load_ts = '20250402_0600'").collect()) == ["g4"]


def test_first_load_empty_root(spark, tmpdir_path):
    df = ig.read_snapshots(spark, f"{tmpdir_path}/nothing", schemas.GAMES)
    assert df.count() == 0 and "load_ts" in df.columns
    assert "load_ts" not in schemas.GAMES.names  # module schema untouched


def test_select_unscored(spark):
    rows = [game(uuid="s1"), game(uuid="u1"), game(uuid="u1", username="Bob"), game(uuid="v", rules="chess960"),
            game(uuid="e", text="")]
    g = games_df(spark, rows).withColumn("load_ts", F.lit("1"))
    g = g.withColumn("load_ts", F.when((F.col("game_uuid") == "u1") & (F.col("username") == "Bob"), "2")
                     .otherwise(F.col("load_ts")))
    m = moves_df(spark, "s1", [0, 0])
    got = [(r.game_uuid, r.username) for r in ig.select_unscored_games(g, m).collect()]
    assert got == [("u1", "Bob")]  # one row per game, the latest load


# ---------------------------------------------------------------- scoring

def test_extract_plies(spark):
    text = pgn(["0:03:00", "0:02:59", "0:02:50"], moves=["e4", "e5", "Nf3"], header='[Date "2024.01.01"] ')
    g = games_df(spark, [game(uuid="p", text=text)])
    got = [(r.move_number, r.move, r.time_remaining_seconds) for r in sc.extract_plies(g).orderBy("move_number").collect()]
    assert got == [(1, "e4", 180.0), (2, "e5", 179.0), (3, "Nf3", 170.0)]


@pytest.mark.parametrize("text,moves", [
    ("1. e4 e5 2. Nf3 Nc6 3. Bb5 a6", ["e4", "e5", "Nf3", "Nc6", "Bb5", "a6"]),
    ('[Event "A (b) 1. x"]\n[Site "?"]\n\n1. e4 {best (by test) 2. d4} e5 (1... c5 2. Nf3 (2. c3 d5) d6) 2. Nf3 $1 1-0', ["e4", "e5", "Nf3"]),
    ("1.e4 e5 2.O-O 1/2-1/2", ["e4", "e5", "O-O"]), ("*", []), ("", []), (None, []),
])
def test_ply_tokens_of_any_move_text(spark, text, moves):
    df = spark.createDataFrame([(text,)], "pgn string").select(sc.ply_tokens("pgn").alias("t"))
    assert (df.first().t or []) == moves


def test_extract_plies_keeps_keyless_games_apart(spark):
    rows = [game(uuid="", text="1. a b 2. c"), game(uuid="", text="1. a b 2. c d 3. e"),
            game(uuid="k", text="1. a b"), game(uuid="k", username="Bob", text="1. a b")]
    out = sc.extract_plies(games_df(spark, rows))
    assert out.filter("game_uuid = ''").count() == 8 and out.filter("game_uuid = 'k'").count() == 2


def test_scoring_uses_all_cores_by_default(spark):
    rows = [game(uuid=f"g{i}", text="1. e4 e5") for i in range(400)]
    out = sc.score_moves(games_df(spark, rows), lambda: sc.TokenTableEvaluator({}))
    parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= spark.sparkContext.defaultParallelism


def test_score_hook(spark):
    rows = [game(uuid="a", text=pgn(clocks_falling(3), moves=["e4", "e5", "Qh5"])), game(uuid="empty", text="*")]
    out = sc.score_moves(games_df(spark, rows), lambda: sc.TokenTableEvaluator({"Qh5": 90, "e5": 10}), 2)
    got = [(r.game_uuid, r.move_number, r.move, r.score_white) for r in out.orderBy("move_number").collect()]
    assert got == [("a", 1, "e4", 0), ("a", 2, "e5", -10), ("a", 3, "Qh5", 80)]


# ---------------------------------------------------------------- streaming

def test_ingest_stream_runs_once(spark, tmpdir_path):
    from plyscope.streaming.ingest_stream import ingest_stream
    landing, root, ckpt = f"{tmpdir_path}/landing", f"{tmpdir_path}/games", f"{tmpdir_path}/ckpt"
    _land(landing, "alice", "2025-03", [_api_game("s1", 100), _api_game("s2", 200)])
    clock = lambda: dt.datetime(2025, 3, 31, 6, 0)
    ingest_stream(spark, landing, root, ckpt, clock=clock).awaitTermination()
    assert ig.read_snapshots(spark, root, schemas.GAMES).count() == 2
    ingest_stream(spark, landing, root, ckpt, clock=clock).awaitTermination()   # nothing new
    assert ig.read_snapshots(spark, root, schemas.GAMES).count() == 2
    _land(landing, "alice", "2025-03", [_api_game("s3", 300), _api_game("late", 150)])
    ingest_stream(spark, landing, root, ckpt, clock=clock).awaitTermination()
    got = sorted(r.game_uuid for r in ig.read_snapshots(spark, root, schemas.GAMES).collect())
    assert got == ["s1", "s2", "s3"]   # the late game (ends before the mark) is not loaded, as documented


def test_ingest_stream_takes_the_mark_once_per_run(spark, tmpdir_path):
    """Two micro-batches in one run, the newer month first: the older month's games are not lost."""
    import time
    from plyscope.streaming.ingest_stream import ingest_stream
    landing, root, ckpt = f"{tmpdir_path}/landing", f"{tmpdir_path}/games", f"{tmpdir_path}/ckpt"
    _land(landing, "alice", "2025-03", [_api_game("new", 900)])
    time.sleep(1.1)  # the file source reads older files first
    _land(landing, "alice", "2025-02", [_api_game("old", 100)])
    ingest_stream(spark, landing, root, ckpt, files_per_batch=1).awaitTermination()
    got = ig.read_snapshots(spark, root, schemas.GAMES)
    assert sorted(r.game_uuid for r in got.collect()) == ["new", "old"]
    assert got.select("load_ts").distinct().count() == 2


def test_load_reads_only_selected_archives(spark, tmpdir_path):
    landing, root = f"{tmpdir_path}/landing", f"{tmpdir_path}/games"
    _land(landing, "alice", "2025-01", [_api_game("g1", 100)])
    _land(landing, "alice", "2025-02", [_api_game("g2", 200)])
    _land(landing, "a b", "2025-01", [_api_game("g3", 50)])
    ig.load_games(spark, landing, root, P, now=dt.datetime(2025, 3, 1))
    history = ig.load_history(ig.read_snapshots(spark, root, schemas.GAMES))
    listed = {(r.username, r.archive) for r in ig.list_archives(spark, landing).collect()}
    assert listed == {("alice", "2025-01"), ("alice", "2025-02"), ("a b", "2025-01")}
    chosen = ig.read_selected_lines(spark, landing, history, P)
    assert [r.archive for r in chosen.filter("username = 'alice'").collect()] == ["2025-02"]
    assert chosen.count() == 2
    late = ig.read_selected_lines(spark, landing, history, P.with_(min_archive="2025/02"))
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(late._jdf.queryExecution(), "formatted")
    scan = [x for x in plan.splitlines() if x.startswith("PartitionFilters") and "2025-02" in x]
    assert scan and "alice" in scan[0] and late.count() == 1


def test_unreadable_root_is_not_a_first_load(spark, tmpdir_path):
    open(f"{tmpdir_path}/junk.parquet", "w").write("no parquet")
    with pytest.raises(Exception, match="junk.parquet"):
        ig.read_snapshots(spark, f"{tmpdir_path}/junk.parquet", schemas.GAMES).count()


def test_landed_objects_are_bounded(spark, tmpdir_path):
    rows = [game(uuid=f"g{i}", end=1000 + i) for i in range(50)]
    ig.land_archives(games_df(spark, rows), f"{tmpdir_path}/l", games_per_object=5)
    back = ig.read_archive_json(spark, f"{tmpdir_path}/l")
    assert back.count() > 4 and back.select(F.explode("games")).count() == 50


def test_score_new_games_incremental(spark, tmpdir_path):
    from plyscope import pipeline
    games_root, moves_root = f"{tmpdir_path}/games", f"{tmpdir_path}/moves"
    rows = [game(uuid="a", text=pgn(clocks_falling(2), moves=["e4", "e5"])),
            game(uuid="b", text=pgn(clocks_falling(3), moves=["d4", "d5", "c4"]))]
    ig.append_snapshot(games_df(spark, rows), games_root, "1")
    factory = lambda: sc.TokenTableEvaluator({"e4": 30})
    pipeline.score_new_games(spark, games_root, moves_root, factory, load_ts="m1", num_partitions=2)
    moves = ig.read_snapshots(spark, moves_root, schemas.MOVES)
    assert moves.count() == 5
    # second run: nothing left to score, no new snapshot
    pipeline.score_new_games(spark, games_root, moves_root, factory, load_ts="m2", num_partitions=2)
    assert not os.path.exists(f"{moves_root}/load_ts=m2")
    ig.append_snapshot(games_df(spark, [game(uuid="c", text=pgn(clocks_falling(1)))]), games_root, "2")
    pipeline.score_new_games(spark, games_root, moves_root, factory, load_ts="m3", num_partitions=2)
    got = ig.read_snapshots(spark, moves_root, schemas.MOVES).filter("load_ts = 'm3'").collect()
    assert [(r.game_uuid, r.move_number, r.score_white) for r in got] == [("c", 1, 30)]
