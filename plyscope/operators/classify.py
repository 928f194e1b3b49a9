"""Swing classification: mistakes, blunders and massive blunders, for either side, with context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyscope.params import Params

MASSIVE = "Massive Blunder"
BLUNDER = "Blunder"
MISTAKE = "Mistake"
BLUNDERS = (BLUNDER, MASSIVE)


def _playing_conditions(p: Params, turn: Column, delta: Column, prev: Column, score: Column):
    balanced = (prev > -p.balanced_limit) & (score < p.balanced_limit)
    massive = turn & (delta <= -p.massive_blunder_drop) & balanced
    blunder = turn & (delta <= -p.blunder_drop) & balanced
    mistake = turn & (delta <= -p.mistake_drop)
    return massive, blunder, mistake


def _opponent_conditions(p: Params, turn: Column, delta: Column, prev: Column, score: Column):
    balanced = (prev < p.balanced_limit) & (score > -p.balanced_limit)
    not_turn = ~turn
    massive = not_turn & (delta >= p.massive_blunder_drop) & balanced
    blunder = not_turn & (delta >= p.blunder_drop) & balanced
    mistake = not_turn & (delta >= p.mistake_drop)
    return massive, blunder, mistake


def _category(massive: Column, blunder: Column, mistake: Column) -> Column:
    return (F.when(massive, F.lit(MASSIVE)).when(blunder, F.lit(BLUNDER)).when(mistake, F.lit(MISTAKE)))


def classify_misses(df: DataFrame, p: Params = Params(), turn: str = "is_playing_turn",
                    delta: str = "variance_score_playing", prev: str = "prev_score_playing",
                    score: str = "score_playing", step: str = "move_number") -> DataFrame:
    """Own-turn and opponent-turn miss categories and their plies.

    A drop in a lopsided position (previous ≤ −limit or new ≥ +limit) is only a Mistake.
    """
    t, d, pv, s, n = (F.col(x) for x in (turn, delta, prev, score, step))
    pm, pb, pk = _playing_conditions(p, t, d, pv, s)
    om, ob, ok = _opponent_conditions(p, t, d, pv, s)
    return df.withColumns({
        "miss_category_playing": _category(pm, pb, pk),
        "miss_move_number_playing": F.when(pk, n),
        "massive_blunder_move_number_playing": F.when(pm, n),
        "miss_category_opponent": _category(om, ob, ok),
        "miss_move_number_opponent": F.when(ok, n),
    })


def miss_context(category: Column, prev_status: Column) -> Column:
    """A (massive) blunder after Even/Disadvantage is a Throw, after Advantage a Missed Opportunity."""
    is_blunder = category.isin(*BLUNDERS)
    return (F.when(is_blunder & prev_status.isin("Even", "Disadvantage"), F.lit("Throw"))
             .when(is_blunder & prev_status.isin("Advantage"), F.lit("Missed Opportunity")))


def massive_blunder_turn(playing: Column, opponent: Column, turn_name: Column) -> Column:
    """Turn name of a ply holding a massive blunder by either side (input of M25)."""
    return F.when(F.coalesce(playing, opponent) == F.lit(MASSIVE), turn_name)
