"""Scalar column builders (JVM-side expressions only; no Python per row).

Each function takes and returns ``Column`` objects, so they compose inside whole-stage codegen
and can be applied to any table whose columns carry the same meaning.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plyscope.params import (
    CLOCK_HOURS_PATTERN, CLOCK_MARK_PATTERN, CLOCK_MINUTES_PATTERN, CLOCK_SECONDS_PATTERN,
    RESULTS_DRAW, RESULTS_LOSE, RESULTS_WIN, STANDARD_INITIAL_SETUP,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- game-level (M1–M7)

def is_processable_game(pgn="pgn", rules="rules", initial_setup="initial_setup") -> Column:
    """M1: non-empty move text, standard rules, empty or standard set-up."""
    setup = _c(initial_setup)
    return ((F.length(_c(pgn)) > 0) & (_c(rules) == F.lit("chess"))
            & ((F.length(setup) == 0) | (setup == F.lit(STANDARD_INITIAL_SETUP))))


def local_datetime(epoch_seconds="end_time_integer", tz: str = "Europe/Paris") -> Column:
    """M2: epoch seconds → wall-clock TIMESTAMP_NTZ in ``tz`` (DST aware).

    The seconds are added to a zone-free 1970-01-01, which is the wall clock in UTC, and converted
    from there. No wall clock of the session zone (ambiguous for an hour a year) is ever formed.
    """
    secs = _c(epoch_seconds)
    days = F.floor(secs / 86400)
    utc = (F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
           + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), (secs - days * 86400).cast("decimal(18,6)")))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_date(local_dt: Column) -> Column:
    return F.to_date(local_dt)


def local_month(local_dt: Column) -> Column:
    return F.date_format(local_dt, "yyyy-MM")


def orient_side(username="username", white="white_username", black="black_username") -> Column:
    """M3: 'White' / 'Black' / NULL by case-insensitive name match, white tested first."""
    u = F.lower(_c(username))
    return (F.when(u == F.lower(_c(white)), F.lit("White"))
             .when(u == F.lower(_c(black)), F.lit("Black")))


def pick_by_side(side: Column, white_value, black_value) -> Column:
    """M4: the value of the given side ('White' → white_value, 'Black' → black_value, else NULL)."""
    return (F.when(side == F.lit("White"), _c(white_value))
             .when(side == F.lit("Black"), _c(black_value)))


def simplify_result(detailed: Column) -> Column:
    """M5: detailed result code → Win / Lose / Draw / NULL."""
    return (F.when(detailed.isin(*RESULTS_LOSE), F.lit("Lose"))
             .when(detailed.isin(*RESULTS_WIN), F.lit("Win"))
             .when(detailed.isin(*RESULTS_DRAW), F.lit("Draw")))


def turn_color(ply="move_number") -> Column:
    """M6: odd ply is White's, even ply Black's."""
    return F.when(_c(ply) % 2 == 1, F.lit("White")).otherwise(F.lit("Black"))


def win_probability(score: Column, slope: float = 0.004) -> Column:
    """M7: logistic win probability of the side whose score is given."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-slope) * score))


# ---------------------------------------------------------------- clocks (M8, M9)

def clock_marks(pgn="pgn") -> Column:
    """All ``{[%clk h:mm:ss(.f)]}`` marks of a move text, in order (whole match)."""
    return F.regexp_extract_all(_c(pgn), F.lit(CLOCK_MARK_PATTERN), 0)


def _extract_or_null(s: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))


def clock_to_seconds(mark: Column) -> Column:
    """M9: hours·3600 + minutes·60 + seconds (fraction kept); NULL when a part is missing."""
    h = _extract_or_null(mark, CLOCK_HOURS_PATTERN).cast("bigint")
    m = _extract_or_null(mark, CLOCK_MINUTES_PATTERN).cast("bigint")
    s = _extract_or_null(mark, CLOCK_SECONDS_PATTERN).cast("double")
    return h * 3600 + m * 60 + s


def clock_seconds_array(pgn="pgn") -> Column:
    """Seconds left after each ply, as an array indexed by ply − 1 (no explode, no join)."""
    return F.transform(clock_marks(pgn), clock_to_seconds)


# ---------------------------------------------------------------- bands

def band_phase(ply: Column, phases: Sequence) -> Column:
    """Label of the first phase whose inclusive upper ply is ≥ ply; the open last phase otherwise."""
    expr = None
    last = None
    for upper, label, _ in phases:
        if upper is None:
            last = label
            continue
        expr = F.when(ply <= upper, F.lit(label)) if expr is None else expr.when(ply <= upper, F.lit(label))
    return expr.otherwise(F.lit(last)) if expr is not None else F.lit(last)


def rating_band_labels(edges: Sequence[int]) -> list[tuple[int, str]]:
    """(upper edge, label) pairs: '< edge' → 'lo-hi', both zero-padded to four digits."""
    out = []
    for i, edge in enumerate(edges):
        lo = edges[i - 1] if i > 0 else 0
        out.append((edge, f"{lo:04d}-{edge:04d}"))
    return out


def band_rating(rating: Column, edges: Sequence[int]) -> Column:
    """Rating band; an edge belongs to the upper band; NULL and ≥ last edge → 'NNNN+'."""
    expr = None
    for edge, label in rating_band_labels(edges):
        expr = F.when(rating < edge, F.lit(label)) if expr is None else expr.when(rating < edge, F.lit(label))
    top = F.lit(f"{edges[-1]:04d}+")
    return expr.otherwise(top) if expr is not None else top


def position_status(score: Column, even_limit: int) -> Column:
    """|s| ≤ limit Even; s ≤ −limit Disadvantage; s ≥ limit Advantage; NULL score → NULL."""
    return (F.when(F.abs(score) <= even_limit, F.lit("Even"))
             .when(score <= -even_limit, F.lit("Disadvantage"))
             .when(score >= even_limit, F.lit("Advantage")))


def max_score_range(max_score: Column, low: int, mid: int) -> Column:
    """M28: '0-low' / 'low-mid' / 'mid+' (NULL falls to the last band)."""
    return (F.when(max_score < low, F.lit(f"0-{low}"))
             .when(max_score < mid, F.lit(f"{low}-{mid}"))
             .otherwise(F.lit(f"{mid}+")))


def max_score_type(max_score: Column, mid: int) -> Column:
    return F.when(max_score > mid, F.lit("Decisive advantage")).otherwise(F.lit("No decisive advantage"))


# ---------------------------------------------------------------- date windows

def as_of_date(as_of: _dt.date | None) -> Column:
    """``as_of``, or today's date in UTC whatever the session zone."""
    if as_of is not None:
        return F.lit(as_of)
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.current_timestamp()) / 86400).cast("int"))


def month_window_start(as_of: _dt.date | None, months: int) -> Column:
    """First day of the month ``months`` before ``as_of``."""
    return F.trunc(F.add_months(as_of_date(as_of), -months), "MM")


def week_window_start(as_of: _dt.date | None, weeks: int) -> Column:
    """Monday of the ISO week containing ``as_of`` − 7·weeks days."""
    return F.trunc(F.date_sub(as_of_date(as_of), 7 * weeks), "WEEK")


def epoch_lower_bound(start_date: Column) -> Column:
    """A safe lower bound in epoch seconds for any local date ≥ ``start_date`` (any zone, ≤ +14 h).

    Used as an extra, redundant filter on the raw ``end_time_integer`` so that Parquet min/max
    statistics can skip row groups; the exact local-date filter is still applied.
    """
    return F.unix_date(start_date).cast("bigint") * 86400 - 14 * 3600
