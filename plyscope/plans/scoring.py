"""Move extraction (X3) and the pluggable move-scoring hook.

Plies are cut out of the move text JVM-side (regex + posexplode). Scoring needs an external engine,
so it is a hook: the caller passes an evaluator factory, built once per partition inside the Python
worker, that turns the ply tokens of a game into one score per ply (white's view, after the move).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope import schemas
from plyscope.functions import core as fx
from plyscope.functions.nesting import outermost
from plyscope.session import ship_code

MOVES_DDL = "game_uuid string, move_number bigint, move string, score_white bigint"

# What move text holds besides moves. Header lines and comments (in braces, or from a semicolon to the end of
# the line) are found in one pass from left to right, so neither is looked for inside the other.
HEADERS_AND_COMMENTS = (r'(?m)^(?:[ \t]*\[\w+\s*(?:"(?:[^"\\]|\\.)*+")?\s*\])+|\{[^}]*+\}?|;[^\n]*')
GLYPHS_AND_NUMBERS = r"\$\d+|\d+\.+"
RESULT_MARKS = ("1-0", "0-1", "1/2-1/2", "*")


def ply_tokens(pgn="pgn"):
    """The printed moves of a move text in order, whether or not it numbers black's moves. Variations (in
    parentheses, nested to any depth) are left out by the depth automaton; a parenthesis that is never
    closed hides the rest, one that closes nothing is ignored."""
    text = F.col(pgn) if isinstance(pgn, str) else pgn
    text = F.regexp_replace(F.regexp_replace(text, F.lit(HEADERS_AND_COMMENTS), F.lit(" ")), F.lit(GLYPHS_AND_NUMBERS), F.lit(" "))
    tokens = F.regexp_extract_all(text, F.lit(r"[()]|[^\s()]+"), F.lit(0))
    moves = F.when(F.contains(text, F.lit("(")) | F.contains(text, F.lit(")")), outermost(tokens, ("(",), (")",))).otherwise(tokens)
    return F.filter(moves, lambda t: ~t.isin(*RESULT_MARKS))


def extract_plies(games: DataFrame) -> DataFrame:
    """(game, ply, printed move, seconds left) for every ply of every game.

    One row per game with a uuid (several players may have loaded it); keyless games are different
    games and are all kept. Only the extracted arrays are shuffled, not the texts."""
    g = games.select("game_uuid", F.arrays_zip(ply_tokens("pgn").alias("move"),
                                               fx.clock_seconds_array("pgn").alias("secs")).alias("z"))
    keyed = g.filter(F.col("game_uuid") != "").groupBy("game_uuid").agg(F.any_value("z").alias("z"))
    z = keyed.unionByName(g.filter((F.col("game_uuid") == "") | F.col("game_uuid").isNull()))
    return z.select("game_uuid", F.posexplode("z").alias("pos", "p")).select(
        "game_uuid", (F.col("pos") + 1).cast("bigint").alias("move_number"),
        F.col("p.move").alias("move"), F.col("p.secs").alias("time_remaining_seconds"))


Evaluator = Callable[[Sequence[str]], Sequence[int | None]]


def score_moves(games: DataFrame, evaluator_factory: Callable[[], Evaluator],
                num_partitions: int | None = None) -> DataFrame:
    """One row per scored ply ``(game_uuid, move_number, move, score_white)``.

    Games are dealt evenly into ``num_partitions`` (by default four for each core; a given number is
    not coalesced at run time) and each partition builds one evaluator; a game whose text has no
    readable ply yields no rows.
    """
    spark = games.sparkSession
    ship_code(spark)
    parts = num_partitions or 4 * spark.sparkContext.defaultParallelism
    src = games.select("game_uuid", ply_tokens("pgn").alias("tokens")).repartition(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        evaluate = evaluator_factory()
        for pdf in batches:
            rows_uuid, rows_n, rows_mv, rows_sc = [], [], [], []
            for uuid, tokens in zip(pdf["game_uuid"], pdf["tokens"]):
                toks = list(tokens) if tokens is not None else []
                if not toks:
                    continue
                scores = list(evaluate(toks))
                rows_uuid += [uuid] * len(toks)
                rows_n += list(range(1, len(toks) + 1))
                rows_mv += toks
                rows_sc += scores
            yield pd.DataFrame({"game_uuid": pd.Series(rows_uuid, dtype="object"),
                                "move_number": pd.Series(rows_n, dtype="int64"),
                                "move": pd.Series(rows_mv, dtype="object"),
                                "score_white": pd.Series(rows_sc, dtype="Int64")})

    return src.mapInPandas(run, MOVES_DDL)


class TokenTableEvaluator:
    """A minimal evaluator for tests and wiring checks: each printed move adds a fixed centipawn
    value for the side that played it (white +, black −); unknown tokens add 0."""

    def __init__(self, table: dict[str, int] | None = None):
        self.table = table or {}

    def __call__(self, tokens: Sequence[str]) -> list[int]:
        total, out = 0, []
        for i, t in enumerate(tokens):
            v = self.table.get(t, 0)
            total += v if i % 2 == 0 else -v
            out.append(total)
        return out


assert schemas.MOVES.names == ["game_uuid", "move_number", "move", "score_white"]
