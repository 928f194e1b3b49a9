"""Hand-written staging rows (all names and values invented) for the golden tests."""

from __future__ import annotations

import datetime as dt

from plyscope import schemas

AS_OF = dt.date(2025, 3, 31)


def epoch(y, mo, d, h=12, mi=0, s=0) -> int:
    return int((dt.datetime(y, mo, d, h, mi, s) - dt.datetime(1970, 1, 1)).total_seconds())


def pgn(clocks: list[str], moves: list[str] | None = None, header: str = "") -> str:
    """Move text with one clock mark per ply: '1. e4 {[%clk 0:02:59.9]} 1... e5 {[%clk ...]} '."""
    parts = [header] if header else []
    for i, c in enumerate(clocks, start=1):
        n = (i + 1) // 2
        mv = moves[i - 1] if moves else ("e4" if i % 2 else "e5")
        prefix = f"{n}. " if i % 2 == 1 else f"{n}... "
        parts.append(f"{prefix}{mv} {{[%clk {c}]}} ")
    return "".join(parts)


def clocks_falling(n: int, start: int = 180, step: int = 2) -> list[str]:
    out = []
    for i in range(n):
        s = start - step * (i // 2)
        out.append(f"0:{s // 60:02d}:{s % 60:02d}")
    return out


def game(username="Alice", uuid="g1", white="alice", black="bob", w_res="win", b_res="checkmated",
         w_rating=1000, b_rating=1000, end=None, time_class="blitz", rated=True, rules="chess",
         setup="", text=None, archive="https://x/pub/player/alice/games/2025/03", load="2025-03-31 06:00:00"):
    return {"archive_url": archive, "username": username, "bq_load_date": load, "url": f"https://x/game/{uuid}",
            "pgn": text if text is not None else pgn(clocks_falling(4)), "time_control": "180",
            "end_time_integer": end if end is not None else epoch(2025, 3, 20), "rated": rated, "tcn": "",
            "game_uuid": uuid, "initial_setup": setup, "fen": "", "time_class": time_class, "rules": rules,
            "white_username": white, "white_rating": w_rating, "white_result": w_res, "white_id": "",
            "white_uuid": "", "black_username": black, "black_rating": b_rating, "black_result": b_res,
            "black_id": "", "black_uuid": ""}


def games_df(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in schemas.GAMES.names) for r in rows], schemas.GAMES)


def moves_df(spark, game_uuid, scores, start=1):
    rows = [(game_uuid, i, "m", s) for i, s in enumerate(scores, start=start)]
    return spark.createDataFrame(rows, schemas.MOVES)
