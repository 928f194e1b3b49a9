"""Golden mini-dataset: hand-computed move-grain, aggregate, grid and benchmark results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plyscope.params import Params
from plyscope.plans import datamart as dm
from plyscope.plans import intermediate as im
from plyscope.plans import reporting as rp

from fixtures import AS_OF, clocks_falling, epoch, game, games_df, moves_df, pgn

P = Params(as_of=AS_OF)


def _gwm(spark, games, moves, params=P, mapping=None):
    g = im.games(games_df(spark, games), params)
    m = im.games_moves(moves, params)
    mp = mapping if mapping is not None else rp.mapping_frame(spark, params)
    return rp.games_with_moves(g, m, mp, params)


def test_clean_games_filters(spark):
    rows = [game(uuid="ok"), game(uuid="variant", rules="chess960"), game(uuid="empty", text=""),
            game(uuid="setup", setup="8/8/8/8/8/8/8/K6k w - - 0 1"),
            game(uuid="stdsetup", setup="rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1")]
    got = sorted(r.game_uuid for r in im.games(games_df(spark, rows), P).collect())
    assert got == ["ok", "stdsetup"]


def test_games_side_and_result(spark):
    rows = [game(uuid="w", username="ALICE", white="alice", black="bob", w_res="win", b_res="resigned",
                 w_rating=1200, b_rating=900),
            game(uuid="b", username="alice", white="bob", black="Alice", w_res="agreed", b_res="agreed",
                 w_rating=1300, b_rating=1100),
            game(uuid="n", username="alice", white="bob", black="carol", w_res="win", b_res="timeout")]
    got = {r.game_uuid: r for r in im.games(games_df(spark, rows), P).collect()}
    assert (got["w"].playing_as, got["w"].playing_result, got["w"].playing_rating, got["w"].opponent_rating) == \
        ("White", "Win", 1200, 900)
    assert (got["b"].playing_as, got["b"].playing_result, got["b"].playing_rating, got["b"].opponent_rating) == \
        ("Black", "Draw", 1100, 1300)
    assert (got["n"].playing_as, got["n"].playing_result, got["n"].playing_rating) == (None, None, None)


def test_games_times_quirks(spark):
    rows = [game(uuid="c", text=pgn(["0:03:00", "0:02:59.5", "335:59:58"])), game(uuid="none", text="1. e4 e5")]
    t = im.games_times(im.games(games_df(spark, rows), P)).orderBy("game_uuid", "move_number").collect()
    assert [(r.game_uuid, r.move_number, r.time_remaining_seconds) for r in t] == \
        [("c", 1, 180.0), ("c", 2, 179.5), ("c", 3, 33 * 3600 + 59 * 60 + 58.0)]


def _scores_game(spark, scores, playing="White", uuid="g1", **kw):
    white, black = ("alice", "bob") if playing == "White" else ("bob", "alice")
    g = game(uuid=uuid, white=white, black=black, text=pgn(clocks_falling(len(scores))), **kw)
    return g, moves_df(spark, uuid, scores)


def test_swing_categories_white(spark):
    # White plies are odd. Score after each ply (white's view).
    scores = [0, 0,      # 1 W, 2 B
              -100, -100,  # 3: W drop 100 → Mistake
              -199, -199,  # 5: W drop 99 → nothing
              -449, -449,  # 7: W drop 250 from -199 (prev > -200) → Blunder
              -1049, -1049,  # 9: drop 600 from -449: prev ≤ -200 → only Mistake (lopsided)
              0, 0,        # 11: +1049 own turn: nothing
              -600, 0]     # 13: drop 600 from 0, new -600 < 200 → Massive; 14: B ply, +600 for us (opponent)
    g, m = _scores_game(spark, scores)
    w = {r.move_number: r for r in _gwm(spark, [g], m).collect()}
    assert w[3].miss_category_playing == "Mistake" and w[3].miss_move_number_playing == 3
    assert w[5].miss_category_playing is None
    assert w[7].miss_category_playing == "Blunder"
    assert w[9].miss_category_playing == "Mistake"
    assert w[13].miss_category_playing == "Massive Blunder" and w[13].massive_blunder_move_number_playing == 13
    assert w[14].miss_category_opponent == "Massive Blunder" and w[14].miss_move_number_opponent == 14
    assert w[13].first_blunder_playing_turn_name == "Playing Turn"
    assert all(r.first_blunder_playing_turn_name == "Playing Turn" for r in w.values())
    assert w[1].prev_score_playing is None and w[3].variance_score_playing == -100


def test_swing_balance_limits(spark):
    # prev must be > -200 and new < 200 for (massive) blunders.
    cases = {  # (prev, new) → category at the drop ply (own turn = ply 3)
        (-199, -449): "Blunder", (-200, -450): "Mistake", (449, 199): "Blunder", (450, 200): "Mistake",
        (0, -249): "Mistake", (0, -250): "Blunder", (0, -599): "Blunder", (100, -500): "Massive Blunder",
    }
    for i, ((prev, new), expect) in enumerate(cases.items()):
        g, m = _scores_game(spark, [prev, prev, new, new], uuid=f"b{i}")
        r = [x for x in _gwm(spark, [g], m).collect() if x.move_number == 3][0]
        assert r.miss_category_playing == expect, (prev, new)


def test_black_side_and_context(spark):
    # Playing black: score_playing = -score_white; black plies are even.
    scores = [0, 0, 0, -50, 0, 350, 0, 0]  # ply 4: +50 for black; ply 6: black drops 350 from 0
    g, m = _scores_game(spark, scores, playing="Black")
    w = {r.move_number: r for r in _gwm(spark, [g], m).collect()}
    assert w[4].score_playing == 50 and w[4].is_playing_turn
    assert w[6].score_playing == -350 and w[6].variance_score_playing == -350
    assert w[6].miss_category_playing == "Blunder"
    assert w[5].position_status_playing == "Even" and w[6].miss_context_playing == "Throw"


@pytest.mark.parametrize("prev,status,context", [(-151, "Disadvantage", "Throw"), (-150, "Even", "Throw"),
                                                  (150, "Even", "Throw"), (151, "Advantage", "Missed Opportunity")])
def test_miss_context(spark, prev, status, context):
    scores = [prev, prev, prev - 300, prev - 300]
    g, m = _scores_game(spark, scores, uuid=f"ctx{prev}")
    w = {r.move_number: r for r in _gwm(spark, [g], m).collect()}
    assert w[2].position_status_playing == status
    assert w[3].miss_category_playing in ("Blunder", "Massive Blunder", "Mistake")
    if w[3].miss_category_playing in ("Blunder", "Massive Blunder"):
        assert w[3].miss_context_playing == context


def test_first_massive_side_opponent_first(spark):
    scores = [0, 700, 700, 0]  # ply 2: the opponent (black) gives away 700 → opponent's massive blunder first
    g, m = _scores_game(spark, scores)
    w = _gwm(spark, [g], m).collect()
    assert {r.first_blunder_playing_turn_name for r in w} == {"Opponent Turn"}
    g2, m2 = _scores_game(spark, [0, 0, 10, 10], uuid="quiet")
    assert {r.first_blunder_playing_turn_name for r in _gwm(spark, [g2], m2).collect()} == {None}


def test_time_ratio_min_and_increment(spark):
    clocks = ["0:03:00", "0:03:00", "0:02:00", "0:02:30", "0:01:30", "0:02:40", "0:00:30", "0:03:10"]
    g = game(uuid="t", text=pgn(clocks))
    m = moves_df(spark, "t", [0, 0, -300, 0, -300, 0, -300, 0])  # own blunders on plies 3, 5, 7
    w = {r.move_number: r for r in _gwm(spark, [g], m).collect()}
    assert w[3].prct_time_remaining == pytest.approx(120 / 180)
    assert w[8].prct_time_remaining == pytest.approx(190 / 180)  # increment: above 1
    a = rp.aggregate_games(_gwm(spark, [g], m), P).filter("aggregation_level = 'Games'").collect()[0]
    # the minimum ratio is kept, which without increment is the last blunder (ply 7), not the first
    assert a.first_blunder_playing_prct_time_remaining == pytest.approx(30 / 180)


def test_ratio_base_zero_is_null(spark):
    g = game(uuid="z", text=pgn(["0:00:00", "0:01:00", "0:00:00", "0:00:50"]))
    w = {r.move_number: r for r in _gwm(spark, [g], moves_df(spark, "z", [0, 0, 0, 0])).collect()}
    assert w[1].prct_time_remaining is None and w[2].prct_time_remaining == 1.0


def test_aggregate_two_levels(spark):
    # 70 plies: all four phases; massive blunders on plies 9 and 10? only own (odd) plies count.
    n = 70
    scores = [0] * n
    scores[8] = -700      # ply 9: massive (own)
    scores[9] = -700
    scores[10] = 0        # ply 11: +700 own
    scores[11] = 0
    scores[20] = -300     # ply 21: blunder (own, mid game)
    scores[21:] = [-300] * (n - 21)
    g, m = _scores_game(spark, scores, uuid="agg")
    w = _gwm(spark, [g], m)
    a = rp.aggregate_games(w, P).collect()
    levels = {(r.aggregation_level, r.game_phase_key): r for r in a}
    assert set(levels) == {("Games", "Recent Games"), ("Game Phases", "1-Early Game"), ("Game Phases", "2-Mid Game"),
                           ("Game Phases", "3-Late Game"), ("Game Phases", "4-Very Late Game")}
    game_row = levels[("Games", "Recent Games")]
    assert game_row.game_phase is None and game_row.nb_moves == 70
    assert game_row.nb_massive_blunder_playing == 1 and game_row.nb_blunder_playing == 2
    assert game_row.nb_massive_blunder_early_playing == 1 and game_row.nb_blunder_mid_playing == 1
    assert game_row.massive_blunder_move_number_playing == "9"
    phase_sum = sum(r.nb_moves for k, r in levels.items() if k[0] == "Game Phases")
    assert phase_sum == game_row.nb_moves
    assert sum(r.nb_blunder_playing for k, r in levels.items() if k[0] == "Game Phases") == 2
    assert levels[("Game Phases", "4-Very Late Game")].nb_moves == 5
    assert game_row.max_score_playing == 0 and game_row.max_score_playing_range == "0-300"
    assert game_row.has_enough_games is False
    # phase-level pivot columns are counted on the un-nulled phase column
    assert levels[("Game Phases", "1-Early Game")].nb_massive_blunder_early_playing == 1
    assert levels[("Game Phases", "2-Mid Game")].nb_massive_blunder_early_playing == 0


def test_string_agg_numeric_order_and_stats(spark):
    scores = [0] * 12
    for ply in (3, 9, 11):      # own plies with massive drops, each from 0
        scores[ply - 1] = -700
    # give the massive blunder plies a recovery so the next one is again from 0
    g, m = _scores_game(spark, scores, uuid="s")
    a = rp.aggregate_games(_gwm(spark, [g], m), P).filter("aggregation_level = 'Games'").collect()[0]
    assert a.massive_blunder_move_number_playing == "3, 9, 11"   # numeric, not text order
    one = [0]
    g1, m1 = _scores_game(spark, one, uuid="one")
    r = rp.aggregate_games(_gwm(spark, [g1], m1), P).filter("aggregation_level = 'Games'").collect()[0]
    assert r.std_score_playing is None and r.median_score_playing == 0
    assert r.massive_blunder_move_number_playing is None


def test_median_is_lower_middle(spark):
    g, m = _scores_game(spark, [10, 20, 30, 40], uuid="med")
    r = rp.aggregate_games(_gwm(spark, [g], m), P).filter("aggregation_level = 'Games'").collect()[0]
    assert r.median_score_playing == 20


def test_has_enough_games_strict(spark):
    p = P.with_(min_games_played=2)
    rows, moves = [], None
    for i in range(3):
        g, m = _scores_game(spark, [0, 0], uuid=f"e{i}")
        rows.append(g)
        moves = m if moves is None else moves.unionByName(m)
    a = rp.aggregate_games(_gwm(spark, rows, moves, p), p).filter("aggregation_level = 'Games'").collect()
    assert all(r.has_enough_games for r in a)  # 3 > 2
    a2 = rp.aggregate_games(_gwm(spark, rows[:2], moves, p), p).filter("aggregation_level = 'Games'").collect()
    assert not any(r.has_enough_games for r in a2)  # 2 is not > 2


def test_scope_and_alias(spark):
    rows = [game(uuid="old", end=epoch(2024, 9, 30)), game(uuid="new", end=epoch(2024, 10, 1, 10)),
            game(uuid="daily", time_class="daily"), game(uuid="unrated", rated=False),
            game(uuid="alias", username="Alt_Alice", white="alt_alice", black="x")]
    g = im.games(games_df(spark, rows), P)
    s = rp.scope_games(g, P)
    assert sorted(r.game_uuid for r in s.collect()) == ["alias", "new"]
    p = P.with_(username_mapping=(("alt_alice", "Alice"), ("Alice", "Alice")))
    merged = {r.game_uuid: r.username for r in rp.merge_accounts(s, rp.mapping_frame(spark, p)).collect()}
    assert merged == {"alias": "Alice", "new": "Alice"}


def test_sample_grid(spark):
    scores = list(range(1, 34))    # 33 plies, score = ply for white
    g, m = _scores_game(spark, scores, uuid="grid", end=epoch(2025, 3, 26))
    old, m_old = _scores_game(spark, [1, 2], uuid="sunday", end=epoch(2025, 3, 23, 12))  # Sunday before the week
    w = _gwm(spark, [g, old], m.unionByName(m_old))
    r = dm.sample_grid(w, P).orderBy("move_number").collect()
    assert {x.game_uuid for x in r} == {"grid"}
    assert [x.move_number for x in r] == [1] + list(range(5, 61, 5))
    got = {x.move_number: x.score_playing for x in r}
    assert got[1] == 1 and got[30] == 30 and got[35] == 30 and got[60] == 30


def test_benchmark_matches_plain_join(spark):
    """Total-minus-own cohort counts equal the direct player × cohort join (random data)."""
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        rows.append((rnd.choice(["a", "b", "c", None]), f"g{i}", rnd.choice(["blitz", "rapid"]),
                     rnd.choice(["0400-0600", "0600-0800"]), rnd.choice(["0400-0600", "0600-0800"]),
                     rnd.choice(["Recent Games", "1-Early Game"]), dt.date(2025, 3, rnd.randint(1, 28)),
                     rnd.randint(0, 2), rnd.randint(0, 1), rnd.choice([None, 0.4, 0.6, 0.8, 0.95]),
                     rnd.randint(0, 1), rnd.randint(0, 1)))
    schema = ("username string, game_uuid string, time_class string, playing_rating_range string, "
              "opponent_rating_range string, game_phase_key string, end_time_date date, nb_blunder_playing int, "
              "nb_massive_blunder_playing int, first_massive_blunder_playing_prct_time_remaining double, "
              "nb_throw_playing int, nb_missed_opportunity_playing int")
    agg = spark.createDataFrame(rows, schema).withColumn(
        "aggregation_level", F.when(F.col("game_phase_key") == "Recent Games", "Games").otherwise("Game Phases"))
    p = P.with_(min_games_played=3, benchmark_window_months=1)
    fast = dm.cohort_benchmark(agg, p)
    agg.createOrReplaceTempView("agg_t")
    mine = dm.player_rates(agg, p)
    mine.createOrReplaceTempView("u_t")
    plain = spark.sql(f"""
      SELECT u.username, u.game_phase_key, u.time_class, u.playing_rating_range,
             count(*) AS bench_nb_games,
             count_if(gp.nb_blunder_playing > 0) / count(*) AS bench_rate_nb_blunder_playing,
             count_if(gp.first_massive_blunder_playing_prct_time_remaining > 0.7) / count(*)
               AS bench_rate_nb_massive_blunder_playing_prct_time_70
      FROM u_t u LEFT JOIN agg_t gp
        ON gp.username <> u.username AND gp.game_phase_key = u.game_phase_key
       AND gp.time_class = u.time_class AND gp.playing_rating_range = u.playing_rating_range
      WHERE gp.playing_rating_range = gp.opponent_rating_range
      GROUP BY 1, 2, 3, 4 HAVING count(*) > {p.min_games_played}""")
    cols = ["username", "game_phase_key", "time_class", "playing_rating_range", "bench_nb_games",
            "bench_rate_nb_blunder_playing", "bench_rate_nb_massive_blunder_playing_prct_time_70"]
    a = sorted(tuple(r) for r in fast.select(*cols).collect())
    b = sorted(tuple(r) for r in plain.select(*cols).collect())
    assert a == b and len(a) > 0


def test_most_frequent_range_tie_takes_larger(spark):
    rows = [("u", "blitz", "0400-0600", 5), ("u", "blitz", "0600-0800", 5), ("v", "blitz", "0400-0600", 7),
            ("v", "blitz", "0600-0800", 2)]
    b = spark.createDataFrame(rows, "username string, time_class string, playing_rating_range string, nb_games bigint") \
             .withColumn("aggregation_level", F.lit("Games"))
    got = {r.username: (r.most_relevant_playing_rating_range, r.nb_games) for r in dm.most_frequent_range(b).collect()}
    assert got == {"u": ("0600-0800", 10), "v": ("0400-0600", 9)}


def test_audit_rates(spark):
    g1, m1 = _scores_game(spark, [0, 0, -700, -700], uuid="a1", w_rating=700, b_rating=700)
    g2, m2 = _scores_game(spark, [0, 0, 0, 0], uuid="a2", w_rating=700, b_rating=700)
    g3 = dict(g2, game_uuid="a3", username="Bob", url="u3")
    g3["white_username"], g3["black_username"] = "bob", "x"
    m3 = moves_df(spark, "a3", [0, 0, -300, -300])
    w = _gwm(spark, [g1, g2, g3], m1.unionByName(m2).unionByName(m3))
    r = {x.population: x for x in dm.audit_blunder_rates(w, "Alice", "blitz", "0600-0800", P).collect()}
    assert (r["username"].nb_games, r["username"].nb_games_blunder, r["username"].nb_games_massive_blunder) == (2, 1, 1)
    assert r["username"].rate_blunder == 0.5 and r["username"].rate_massive_blunder == 0.5
    assert (r["benchmark"].nb_games, r["benchmark"].nb_games_blunder, r["benchmark"].rate_massive_blunder) == (1, 1, 0.0)


@pytest.mark.parametrize("keep,rows", [(True, 6), (False, 0)])
def test_keyless_games_switch(spark, keep, rows):
    g1, _ = _scores_game(spark, [0, 0], uuid="")
    g2 = dict(g1, url="other")
    m = moves_df(spark, "", [0, 0, 0])
    assert _gwm(spark, [g1, g2], m, P.with_(keep_keyless=keep)).count() == rows


def test_game_loaded_twice_has_one_row_per_load_and_ply(spark):
    """A (player, game) pair loaded twice: two rows per ply, each with its own row's clocks (a join of
    an exploded clock table would give four)."""
    g1, m = _scores_game(spark, [0, 0], uuid="twice")
    out = _gwm(spark, [g1, dict(g1, url="again")], m).groupBy("move_number").count().collect()
    assert {r.move_number: r["count"] for r in out} == {1: 2, 2: 2}


def test_two_aliases_in_one_game_known_edge(spark):
    """Q4: both accounts of one person in one game merge into one name; plies appear twice and the
    raw account name orders the duplicates, so the result is deterministic."""
    text = pgn(clocks_falling(4))
    a = game(uuid="q4", username="alt_alice", white="alt_alice", black="Alice", text=text)
    b = game(uuid="q4", username="Alice", white="alt_alice", black="Alice", text=text)
    m = moves_df(spark, "q4", [0, -300, -300, 0])
    p = P.with_(username_mapping=(("alt_alice", "Alice"), ("Alice", "Alice")))
    rows = _gwm(spark, [a, b], m, p).collect()
    assert len(rows) == 8 and {r.username for r in rows} == {"Alice"}
    again = _gwm(spark, [b, a], m, p).collect()
    key = lambda r: (r.move_number, r.playing_as, r.prev_score_playing, r.miss_category_playing)
    assert sorted(map(key, rows), key=str) == sorted(map(key, again), key=str)
