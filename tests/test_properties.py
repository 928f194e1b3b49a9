"""Randomized checks: the move-grain classification against a plain-Python statement of the rules."""

import random

from plyscope.params import Params
from plyscope.plans import intermediate as im
from plyscope.plans import reporting as rp

from fixtures import AS_OF, clocks_falling, game, games_df, pgn
from plyscope import schemas

P = Params(as_of=AS_OF)


def _expected(scores, playing_white, p=P):
    """Per ply: (score_playing, prev, delta, miss_playing, miss_opponent, status, prev_status, context)."""
    out, prev, prev_status = [], None, None
    for i, sw in enumerate(scores, start=1):
        s = sw if playing_white else -sw
        turn = (i % 2 == 1) == playing_white
        d = None if prev is None else s - prev
        mp = mo = None
        if d is not None:
            bal_p = prev > -p.balanced_limit and s < p.balanced_limit
            bal_o = prev < p.balanced_limit and s > -p.balanced_limit
            if turn:
                if d <= -p.massive_blunder_drop and bal_p:
                    mp = "Massive Blunder"
                elif d <= -p.blunder_drop and bal_p:
                    mp = "Blunder"
                elif d <= -p.mistake_drop:
                    mp = "Mistake"
            else:
                if d >= p.massive_blunder_drop and bal_o:
                    mo = "Massive Blunder"
                elif d >= p.blunder_drop and bal_o:
                    mo = "Blunder"
                elif d >= p.mistake_drop:
                    mo = "Mistake"
        status = "Even" if abs(s) <= p.even_limit else ("Disadvantage" if s <= -p.even_limit else "Advantage")
        ctx = None
        if mp in ("Blunder", "Massive Blunder"):
            ctx = {"Even": "Throw", "Disadvantage": "Throw", "Advantage": "Missed Opportunity"}.get(prev_status)
        out.append((s, prev, d, mp, mo, status, prev_status, ctx))
        prev, prev_status = s, status
    return out


def test_classification_matches_rules(spark):
    rnd = random.Random(11)
    games, moves, expect = [], [], {}
    for k in range(40):
        n = rnd.randint(1, 60)
        walk, sc = [], 0
        for _ in range(n):
            sc += rnd.choice([-900, -650, -400, -260, -120, -30, 0, 40, 110, 300, 700])
            sc = max(-1500, min(1500, sc))
            walk.append(sc)
        white = rnd.random() < 0.5
        uuid = f"r{k}"
        games.append(game(uuid=uuid, white="alice" if white else "bob", black="bob" if white else "alice",
                          text=pgn(clocks_falling(n))))
        moves += [(uuid, i, "m", v) for i, v in enumerate(walk, start=1)]
        expect[uuid] = _expected(walk, white)
    g = im.games(games_df(spark, games), P)
    m = im.games_moves(spark.createDataFrame(moves, schemas.MOVES), P)
    rows = rp.games_with_moves(g, m, rp.mapping_frame(spark, P), P).collect()
    assert len(rows) == len(moves)
    for r in rows:
        e = expect[r.game_uuid][r.move_number - 1]
        got = (r.score_playing, r.prev_score_playing, r.variance_score_playing, r.miss_category_playing,
               r.miss_category_opponent, r.position_status_playing, r.prev_position_status_playing,
               r.miss_context_playing)
        assert got == e, (r.game_uuid, r.move_number)
    # first massive blunder side, per game
    for uuid, ex in expect.items():
        first = next((("Playing Turn" if e[3] == "Massive Blunder" else "Opponent Turn")
                      for e in ex if "Massive Blunder" in (e[3], e[4])), None)
        got = {r.first_blunder_playing_turn_name for r in rows if r.game_uuid == uuid}
        assert got == {first}, uuid
