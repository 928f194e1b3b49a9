"""DuckDB SQL for every registered query: the oracle of the driver's correctness check.

It states results, not steps. Each game row is one record whose plies, clocks and sides are lists; a
ply sees the ply before it by list index. Categories, bands, phases and outcomes are rows of small
lookup tables. Checks are written from what they mean. The SQL shares only parameters and the
adapter's constants with the Spark code.
"""

from __future__ import annotations

from plyscope import catalog as cat
from plyscope.functions.core import rating_band_labels
from plyscope.params import (
    BLACK_MOVE_NUMBER_PATTERN, CLOCK_MARK_PATTERN, RESULTS_DRAW, RESULTS_LOSE, RESULTS_WIN, STANDARD_INITIAL_SETUP,
    WHITE_MOVE_NUMBER_PATTERN, Params,
)
from plyscope.plans.quality import NOT_NULL_GAMES, NOT_NULL_MOVES
from plyscope.plans.reporting import AGG_COLUMNS, GWM_COLUMNS
from plyscope.sources import adapter as ad
from plyscope.sources.ingest import ARCHIVE_BASE

R = cat.ROUND


def _q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(str, r)) + ")" for r in rows) + ")"


def _pick(key: str, options) -> str:
    """The (zero-based) ``key``-th of some literals."""
    return f"[{', '.join(map(_q, options))}][1 + {key}]"


# ---------------------------------------------------------------- staging (the adapter's rules)

def _staging() -> str:
    case = {name: f"k % {m} = {r}" for name, (m, r) in ad.CASES.items()}
    clock = "3600 - 20 * n"
    tclass = _pick("k % 4", ad.TIME_CLASSES_BY_SUPPKEY)
    control = "map {" + ", ".join(f"{_q(a)}: {_q(b)}" for a, b in ad.TIME_CONTROL_BY_CLASS.items()) + "}"
    return f"""
item AS (
  SELECT l_suppkey AS k, CAST(year(l_shipdate) AS BIGINT) AS y, r_name AS region, l_shipdate AS shipped,
         l_returnflag || l_linestatus AS move, CAST(l_quantity AS INTEGER) * 40 - 1020 AS value,
         CASE WHEN l_suppkey = {ad.KEYLESS_SUPPLIER} THEN '' ELSE concat_ws('-', 'g', l_suppkey, year(l_shipdate)) END AS game_uuid,
         CAST(row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate)
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS BIGINT) AS n
  FROM lineitem, supplier, nation, region
  WHERE l_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
),
played AS (
  SELECT k, y, region, game_uuid, max(shipped) AS ended, max(n) AS plies,
         string_agg(CASE WHEN n % 2 = 1 THEN CAST((n + 1) // 2 AS VARCHAR) || '. '
                         WHEN {case['black_unnumbered']} THEN '' ELSE CAST(n // 2 AS VARCHAR) || '... ' END
                    || move || CASE WHEN {case['no_clocks']} THEN ' '
                         ELSE printf(' {{[%%clk 0:%02d:%02d.5]}} ', CAST(({clock}) // 60 AS INTEGER), CAST(({clock}) % 60 AS INTEGER)) END
                    || CASE WHEN {case['side_lines']} AND n % 10 = 0
                         THEN repeat({_q(ad.SIDE_LINE)}, n // 10 + 1) || repeat(')', n // 10 + 1) || ' ' ELSE '' END,
                    '' ORDER BY n) AS body
  FROM item GROUP BY ALL
),
stg_moves AS (
  SELECT item.game_uuid, n AS move_number, move,
         CAST(trunc(value / CASE WHEN {case['calm']} THEN 20 WHEN {case['quiet']} THEN 4 ELSE 1 END) AS BIGINT) AS score_white
  FROM item JOIN played USING (k, y),
       unnest(range(CASE WHEN {case['ply_scored_twice']} AND n = 2 THEN 2 ELSE 1 END)) AS copy(c)
  WHERE NOT ({case['unscored']}) AND NOT ({case['last_ply_unscored']} AND n = plies)
),
stg_games AS (
  SELECT {_q(ad.URL_PREFIX)} || player || '/games/' || strftime(ended, '%Y/%m') AS archive_url,
         player AS username, {_q(ad.LOAD_DATE)} AS bq_load_date,
         {_q(ad.URL_PREFIX + 'game/')} || concat_ws('-', k, y) AS url,
         CASE WHEN {case['no_text']} THEN '' ELSE body END AS pgn,
         {control}[{tclass}] AS time_control, CAST(epoch(ended) AS BIGINT) AS end_time_integer,
         k % 10 <> 0 AS rated, '' AS tcn, game_uuid,
         CASE WHEN {case['custom_setup']} THEN {_q(ad.CUSTOM_SETUP)}
              WHEN {case['standard_setup']} THEN {_q(STANDARD_INITIAL_SETUP)} ELSE '' END AS initial_setup,
         '' AS fen, {tclass} AS time_class, CASE WHEN {case['other_rules']} THEN 'chess960' ELSE 'chess' END AS rules,
         seats[1] AS white_username,
         CASE WHEN NOT ({case['no_white_rating']}) THEN CAST(350 + (k * 37 % 9) * 200 AS BIGINT) END AS white_rating,
         {_pick('(k + y) % 4', [w for w, _ in ad.RESULTS_BY_CODE])} AS white_result, '' AS white_id, '' AS white_uuid,
         seats[2] AS black_username,
         CAST(350 + ((k * 37 + (y + 1) % 2) % 9) * 200 AS BIGINT) AS black_rating,
         {_pick('(k + y) % 4', [b for _, b in ad.RESULTS_BY_CODE])} AS black_result, '' AS black_id, '' AS black_uuid
  FROM (SELECT *, unnest(CASE WHEN {case['two_players']} THEN [region, {_q(ad.OPPONENT)}] ELSE [region] END) AS player,
               CASE WHEN {case['side_unknown']} THEN ['guest', 'visitor']
                    WHEN k % 2 = 0 THEN [region, {_q(ad.OPPONENT)}] ELSE [{_q(ad.OPPONENT)}, region] END AS seats
        FROM played)
)"""


# ---------------------------------------------------------------- lookups

def _lookups(p: Params) -> str:
    outcome = [(_q(c), _q(label)) for label, codes in (("Lose", RESULTS_LOSE), ("Win", RESULTS_WIN), ("Draw", RESULTS_DRAW))
               for c in codes]
    edges = rating_band_labels(p.rating_edges)
    band = [(low, high, _q(label)) for (high, label), low in zip(edges, [-10**9, *[e for e, _ in edges]])]
    phase = [(2**40 if upto is None else upto, _q(label)) for upto, label, _ in p.game_phases]
    miss = [(_q("Massive Blunder"), p.massive_blunder_drop, True), (_q("Blunder"), p.blunder_drop, True),
            (_q("Mistake"), p.mistake_drop, False)]
    return f"""
outcome AS (SELECT * FROM {_values(outcome)} t(code, label)),
band AS (SELECT * FROM {_values(band)} t(low, high, label)),
phase AS (SELECT * FROM {_values(phase)} t(upto, label)),
-- a miss: how many points the mover lost, and whether the position must have been contested
miss AS (SELECT * FROM {_values(miss)} t(name, loss, contested))"""


def _months_before(p: Params, months: int) -> str:
    return f"CAST(date_trunc('month', DATE {_q(p.as_of)} - INTERVAL {months} MONTH) AS DATE)"


def _games(p: Params) -> str:
    def band(c):
        return f"coalesce((SELECT label FROM band WHERE {c} >= low AND {c} < high), {_q(f'{p.rating_edges[-1]:04d}+')})"
    return f"""
seated AS (
  SELECT *, list_position([lower(white_username), lower(black_username)], lower(username)) AS seat,
         timezone({_q(p.target_timezone)}, to_timestamp(end_time_integer)) AS end_time
  FROM stg_games
  WHERE pgn <> '' AND rules = 'chess' AND initial_setup IN ('', {_q(STANDARD_INITIAL_SETUP)})
),
games AS (
  SELECT seated.* EXCLUDE (seat), CAST(end_time AS DATE) AS end_time_date, strftime(end_time, '%Y-%m') AS end_time_month,
         ['White', 'Black'][seat] AS playing_as, [white_result, black_result][seat] AS playing_result_detailed,
         [white_rating, black_rating][seat] AS playing_rating, [black_rating, white_rating][seat] AS opponent_rating,
         label AS playing_result
  FROM seated LEFT JOIN outcome ON code = [white_result, black_result][seat]
),
-- a game's clocks in seconds, by ply
clocked AS (
  SELECT username, game_uuid, row_number() OVER () AS row, marks,
         list_transform(marks, lambda m: list_sum(list_transform([1, 2, 3], lambda i:
           CAST(string_split(regexp_extract(m, 'clk ([^]]+)', 1), ':')[i] AS DOUBLE) * [3600, 60, 1][i]))) AS secs
  FROM (SELECT *, regexp_extract_all(pgn, {_q(CLOCK_MARK_PATTERN)}) AS marks FROM games)
),
games_times AS (
  SELECT username, game_uuid, marks[i] AS time_remaining, i AS move_number, secs[i] AS time_remaining_seconds
  FROM (SELECT *, unnest(range(1, len(marks) + 1)) AS i FROM clocked)
),
games_moves AS (
  SELECT *, ['Black', 'White'][1 + move_number % 2] AS player_color_turn, -score_white AS score_black,
         1 / (1 + exp(-{p.win_probability_slope} * score_white)) AS win_probability_white,
         1 - 1 / (1 + exp(-{p.win_probability_slope} * score_white)) AS win_probability_black
  FROM stg_moves
),
scoped AS (
  SELECT *, {band('playing_rating')} AS playing_rating_range, {band('opponent_rating')} AS opponent_rating_range
  FROM games
  WHERE end_time_date >= {_months_before(p, p.month_history_depth)} AND rated
    AND list_contains([{', '.join(map(_q, p.time_classes))}], time_class)
)"""


def _status(score: str, p: Params) -> str:
    return (f"CASE WHEN {score} BETWEEN -{p.even_limit} AND {p.even_limit} THEN 'Even' "
            f"ELSE ['Disadvantage', 'Advantage'][CAST((3 + sign({score})) / 2 AS INTEGER)] END")


def _plies(p: Params) -> str:
    """games_with_moves: every ply of a game row, with the ply before it, seen from both chairs."""
    keyed = "" if p.keep_keyless else "WHERE game_uuid <> ''"
    bal = p.balanced_limit
    named = {
        "time_remaining_seconds": "clock", "prct_time_remaining": "clock / nullif(first_clock, 0)", "move_number": "n",
        "game_phase": "(SELECT min_by(label, upto) FROM phase WHERE n <= upto)",
        "player_color_turn": "colour", "is_playing_turn": "own",
        "playing_turn_name": "CASE WHEN own THEN 'Playing Turn' ELSE 'Opponent Turn' END",
        "score_playing": "score", "win_probability_playing": "chance", "prev_score_playing": "before",
        "variance_score_playing": "score - before",
        "miss_category_playing": "CASE WHEN own THEN fault END",
        "miss_move_number_playing": "CASE WHEN own AND fault IS NOT NULL THEN n END",
        "massive_blunder_move_number_playing": "CASE WHEN own AND fault = 'Massive Blunder' THEN n END",
        "miss_category_opponent": "CASE WHEN NOT own THEN fault END",
        "miss_move_number_opponent": "CASE WHEN NOT own AND fault IS NOT NULL THEN n END",
        "position_status_playing": _status("score", p), "prev_position_status_playing": _status("before", p),
        "miss_context_playing": f"CASE WHEN own AND fault <> 'Mistake' THEN map {{'Even': 'Throw', 'Disadvantage': 'Throw', "
                                f"'Advantage': 'Missed Opportunity'}}[{_status('before', p)}] END",
        "first_blunder_playing_turn_name": "first_massive",
    }
    cols = ",\n    ".join(f"{named[c]} AS {c}" if c in named else c for c in GWM_COLUMNS)
    return f"""
record AS (
  SELECT s.*, row_number() OVER () AS row,
         regexp_extract_all(pgn, {_q(CLOCK_MARK_PATTERN)}) AS marks
  FROM scoped s {keyed}
),
scored AS (SELECT game_uuid, list(m ORDER BY m.move_number) AS plies FROM games_moves m GROUP BY game_uuid),
ply AS (
  SELECT record.* EXCLUDE (pgn, marks), u.cur.move_number AS n, u.cur.move AS move, u.cur.player_color_turn AS colour,
         u.cur.player_color_turn = playing_as AS own,
         CASE playing_as WHEN 'White' THEN u.cur.score_white WHEN 'Black' THEN -u.cur.score_white END AS score,
         CASE playing_as WHEN 'White' THEN u.prev.score_white WHEN 'Black' THEN -u.prev.score_white END AS before,
         CASE playing_as WHEN 'White' THEN u.cur.win_probability_white WHEN 'Black' THEN u.cur.win_probability_black END AS chance,
         secs[u.cur.move_number] AS clock, secs[u.start] AS first_clock
  FROM (SELECT record.*, unnest(list_transform(range(1, len(plies) + 1), lambda i: {{'cur': plies[i], 'prev': plies[i - 1],
                 'start': list_min(list_transform(list_filter(plies, lambda q: q.player_color_turn = plies[i].player_color_turn),
                                                  lambda q: q.move_number))}})) AS u,
               list_transform(marks, lambda m: list_sum(list_transform([1, 2, 3], lambda i:
                 CAST(string_split(regexp_extract(m, 'clk ([^]]+)', 1), ':')[i] AS DOUBLE) * [3600, 60, 1][i]))) AS secs
        FROM record JOIN scored USING (game_uuid)) AS record
),
judged AS (
  -- the mover's loss and chair decide the fault: the gravest miss whose conditions hold
  SELECT *, (SELECT max_by(name, loss) FROM miss
             WHERE CASE WHEN own THEN before - score ELSE score - before END >= loss
               AND (NOT contested OR (CASE WHEN own THEN before ELSE -before END > -{bal}
                                      AND CASE WHEN own THEN score ELSE -score END < {bal}))
               AND own IS NOT NULL) AS fault
  FROM ply
),
games_with_moves AS (
  SELECT {cols}
  FROM (SELECT judged.*, first_massive FROM judged LEFT JOIN (
          SELECT row, min_by(CASE WHEN own THEN 'Playing Turn' ELSE 'Opponent Turn' END, n) FILTER (fault = 'Massive Blunder')
                 AS first_massive FROM judged GROUP BY row) USING (row))
)"""


def _agg(p: Params) -> str:
    blunder = "miss_category_playing LIKE '%Blunder'"
    massive = "miss_category_playing = 'Massive Blunder'"
    count = lambda cond: f"CAST(count(*) FILTER ({cond}) AS BIGINT)"
    least = lambda cond: f"min(prct_time_remaining) FILTER ({cond})"
    lo, mid = p.should_win_low, p.should_win_mid
    made = {
        "game_phase_key": "coalesce(game_phase, 'Recent Games')", "aggregation_level": "level",
        "nb_moves": "count(move_number)", "nb_blunder_playing": count(blunder), "nb_massive_blunder_playing": count(massive),
        "nb_moves_above_decisive_advantage": count(f"score_playing > {mid}"),
        "first_blunder_playing_prct_time_remaining": least(blunder),
        "first_massive_blunder_playing_prct_time_remaining": least(massive),
        "massive_blunder_move_number_playing": "string_agg(CAST(massive_blunder_move_number_playing AS VARCHAR), ', ' "
                                               "ORDER BY massive_blunder_move_number_playing)",
        "nb_throw_playing": count("miss_context_playing = 'Throw'"),
        "nb_missed_opportunity_playing": count("miss_context_playing = 'Missed Opportunity'"),
        "median_score_playing": "quantile_disc(score_playing, 0.5)", "max_score_playing": "max(score_playing)",
        "min_score_playing": "min(score_playing)", "std_score_playing": "stddev_samp(score_playing)",
        "max_score_playing_range": f"CASE WHEN max(score_playing) < {lo} THEN '0-{lo}' WHEN max(score_playing) < {mid} "
                                   f"THEN '{lo}-{mid}' ELSE '{mid}+' END",
        "max_score_playing_type": f"concat(CASE WHEN max(score_playing) > {mid} THEN 'D' ELSE 'No d' END, 'ecisive advantage')",
    }
    for _, label, key in p.game_phases:
        here = "" if label is None else f"phase_of_ply = {_q(label)} AND "
        made[f"nb_blunder_{key}_playing"] = count(here + blunder)
        made[f"nb_massive_blunder_{key}_playing"] = count(here + massive)
    keys = ("username", "game_uuid", "game_phase")
    cols = ",\n    ".join(c if c in keys else f"{made.get(c, f'any_value({c})')} AS {c}"
                          for c in AGG_COLUMNS(p) if c != "has_enough_games")
    cell = "username, time_class, end_time_month, opponent_rating_range, game_phase_key"
    return f"""
levelled AS (
  SELECT w.* EXCLUDE (game_phase), w.game_phase AS phase_of_ply, level,
         CASE level WHEN 'Game Phases' THEN w.game_phase END AS game_phase
  FROM games_with_moves w, {_values([(_q('Games'),), (_q('Game Phases'),)])} l(level)
),
summed AS (
  SELECT {cols}
  FROM levelled GROUP BY username, game_uuid, game_phase, level
),
agg_games AS (
  SELECT summed.*, size > {p.min_games_played} AS has_enough_games
  FROM summed JOIN (SELECT {cell}, count(*) AS size FROM summed GROUP BY ALL) USING ({cell})
)"""


def _audit(p: Params, user: str, time_class: str, rating_range: str) -> str:
    return f"""SELECT population, count(game_uuid) AS nb_games, count(*) FILTER (b) AS nb_games_blunder,
  count(*) FILTER (m) AS nb_games_massive_blunder, avg(CAST(b AS INTEGER)) AS rate_blunder, avg(CAST(m AS INTEGER)) AS rate_massive_blunder
FROM {_values([(_q('username'),), (_q('benchmark'),)])} v(population) LEFT JOIN (
  SELECT game_uuid, CASE username WHEN {_q(user)} THEN 'username' ELSE 'benchmark' END AS population,
         bool_or(coalesce(miss_category_playing LIKE '%Blunder', false)) AS b,
         bool_or(coalesce(miss_category_playing = 'Massive Blunder', false)) AS m
  FROM games_with_moves
  WHERE time_class = {_q(time_class)} AND playing_rating_range = {_q(rating_range)} AND opponent_rating_range = {_q(rating_range)}
    AND (username <> {_q(user)} OR end_time_date >= {_months_before(p, p.benchmark_window_months)})
  GROUP BY ALL
) USING (population)
GROUP BY population"""


def _near(score: str) -> str:
    """The middle of a score's bucket: numbers of one binary length, cut into equal steps from the lowest."""
    steps = 2 ** (cat.SKETCH_BITS - 1)
    width = f"CAST(greatest(1, pow(2, floor(log2(greatest(1, abs({score}))))) / {steps}) AS BIGINT)"
    return f"CAST(sign({score}) * (abs({score}) // {width} * {width} + {width} // 2) AS BIGINT)"


def _bench(p: Params) -> str:
    ratio = "first_massive_blunder_playing_prct_time_remaining"
    flags = {"nb_blunder_playing": "nb_blunder_playing > 0", "nb_massive_blunder_playing": "nb_massive_blunder_playing > 0",
             **{f"nb_massive_blunder_playing_prct_time_{round(t * 100)}": f"{ratio} > {t}" for t in p.clock_thresholds},
             "nb_throw_playing": "nb_throw_playing > 0", "nb_missed_opportunity_playing": "nb_missed_opportunity_playing > 0"}
    rates = lambda head: ", ".join(
        f"avg(CAST(coalesce({f}, false) AS INTEGER)) AS {head}rate_{n}" for n, f in flags.items())
    n = p.min_games_played
    return f"""
equals AS (SELECT * FROM agg_games WHERE playing_rating_range = opponent_rating_range),
mine AS (
  SELECT username, time_class, playing_rating_range, game_phase_key, aggregation_level, {rates('')}, count(*) AS nb_games
  FROM equals WHERE end_time_date >= {_months_before(p, p.benchmark_window_months)}
  GROUP BY ALL HAVING nb_games > {n}
),
against AS (
  SELECT mine.*, o.* FROM mine, LATERAL (
    SELECT {rates('bench_')}, count(*) AS bench_nb_games FROM equals e
    WHERE (e.time_class, e.playing_rating_range, e.game_phase_key) = (mine.time_class, mine.playing_rating_range, mine.game_phase_key)
      AND e.username <> mine.username) o
  WHERE bench_nb_games > {n}
),
favourite AS (
  SELECT username, time_class, max(playing_rating_range) FILTER (nb_games = most) AS most_relevant_playing_rating_range,
         CAST(sum(nb_games) AS BIGINT) AS nb_games
  FROM (SELECT *, max(nb_games) OVER (PARTITION BY username, time_class) AS most FROM against WHERE aggregation_level = 'Games')
  GROUP BY ALL
)"""


# ---------------------------------------------------------------- checks

def _checks() -> str:
    printed = lambda pattern: (
        f"list_max(list_transform(regexp_extract_all(pgn, {_q(pattern)}, 1), lambda x: CAST(x AS BIGINT)))")
    return f"""
-- a game's clocks cover plies 1 to their number; its scored plies should begin and end there
covered AS (SELECT game_uuid, max(len(marks)) AS clocks FROM clocked GROUP BY ALL HAVING clocks > 0),
scored_span AS (SELECT game_uuid, count(*) AS rows, max(move_number) AS last, min(move_number) AS first
                FROM games_moves GROUP BY ALL),
off_span AS (
  SELECT game_uuid, clocks AS max_move_number_times, CAST(1 AS BIGINT) AS min_move_number_times,
         last AS max_move_number_moves, first AS min_move_number_moves
  FROM covered JOIN scored_span USING (game_uuid) WHERE last <> clocks OR first <> 1
),
-- the printed move numbers say how many rows a game should have
off_count AS (
  SELECT username, game_uuid, pgn, rows AS nb_moves, p['w'] AS nb_move_p1, p['b'] AS nb_move_p2
  FROM (SELECT username, game_uuid, max(pgn) AS pgn, max({{'w': {printed(WHITE_MOVE_NUMBER_PATTERN)},
               'b': {printed(BLACK_MOVE_NUMBER_PATTERN)}}}) AS p FROM games GROUP BY ALL)
  LEFT JOIN scored_span USING (game_uuid)
  WHERE coalesce(rows, 0) <> coalesce(p['w'], 0) + coalesce(p['b'], 0)
),
nulls AS (
  {' UNION ALL '.join(f"SELECT '{model}' AS model, '{c}' AS column_name, count(*) - count({c}) AS failures FROM {model}"
                      for model, cols in (("games", NOT_NULL_GAMES), ("games_moves", NOT_NULL_MOVES)) for c in cols)}
),
keyless AS (
  SELECT 'games' AS model, count(*) AS failures FROM games WHERE game_uuid = ''
  UNION ALL SELECT 'games_moves', count(*) FROM games_moves WHERE game_uuid = ''
)"""


def _printed(source: str) -> str:
    """The moves of the texts of ``source`` (key, pgn): words at depth 0, where depth counts the parentheses that
    are open before a word; comments are words of their own. Then the game's list of moves."""
    return f"""
word AS (
  SELECT key, i, w, sum(CASE w WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY key ORDER BY i) AS depth
  FROM (SELECT key, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT key, regexp_extract_all(pgn, '\\{{[^}}]*\\}}|[()]|[^\\s(){{}}]+') AS ws FROM ({source})))
),
printed AS (
  SELECT key, list(m ORDER BY i) AS moves
  FROM (SELECT key, i, regexp_replace(w, '^[0-9]+[.]+', '') AS m FROM word WHERE depth = 0 AND w <> ')' AND w NOT LIKE '{{%')
  WHERE m NOT IN ('', '*', '1-0', '0-1', '1/2-1/2') GROUP BY key
)"""


def _damaged() -> str:
    """Staging games dealt to archive lines, with the kind of damage of each line."""
    return f"""
dealt AS (
  SELECT *, count(*) OVER (PARTITION BY username, archive, line) AS size FROM (
    SELECT *, 1 + nth % {cat.GAMES_PER_LINE} AS place, nth // {cat.GAMES_PER_LINE} AS line,
           (nth // {cat.GAMES_PER_LINE} + CAST(archive[-2:] AS INTEGER) + length(username)) % 6 AS kind
    FROM (SELECT *, replace(archive_url[-7:], '/', '-') AS archive,
                 row_number() OVER (PARTITION BY username, archive_url[-7:] ORDER BY url) - 1 AS nth FROM stg_games)
  )
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _rounded(columns, rounded) -> str:
    return ", ".join(f"round({c}, {R}) AS {c}" if c in rounded else c for c in columns)


def oracle_sql() -> dict[str, str]:
    P, PB = cat.P, cat.PB
    st = _staging()

    def model(p: Params, *more: str) -> str:
        return _with(st, _lookups(p), _games(p), *more)

    cleaned, checks = model(P), model(P, _checks())
    plies, agg = model(P, _plies(P)), model(P, _plies(P), _agg(P))
    bench = model(PB, _plies(PB), _agg(PB), _bench(PB))
    ply_rounded = ("win_probability_playing", "prct_time_remaining")
    agg_rounded = ("std_score_playing", "first_blunder_playing_prct_time_remaining",
                   "first_massive_blunder_playing_prct_time_remaining")
    level_keys = ["username", "game_uuid", "game_phase", "game_phase_key", "aggregation_level"]

    def of_games(*columns: str) -> str:
        return cleaned + "SELECT " + ", ".join(columns) + " FROM games"

    def of_plies(*columns: str) -> str:
        return plies + f"SELECT game_uuid, username, {_rounded(columns, ply_rounded)} FROM games_with_moves"

    def of_agg(*columns: str, sql: str = agg) -> str:
        return sql + f"SELECT {_rounded([*level_keys, *columns], agg_rounded)} FROM agg_games"

    whole_agg = agg + f"SELECT {_rounded(AGG_COLUMNS(P), agg_rounded)} FROM agg_games"
    alias = _values([(_q(a), _q(b)) for a, b in cat.ALIAS_SEED])
    grid = ", ".join(str(int(x)) for x in P.sample_grid)
    week = f"CAST(date_trunc('week', DATE {_q(P.as_of)} - INTERVAL {7 * P.recent_window_weeks} DAY) AS DATE)"
    earlier = f"end_time_integer < {cat.PREVIOUS_LOAD_EPOCH}"
    seen = f"seen AS (SELECT username, max(archive_url) AS url, max(end_time_integer) AS mark FROM stg_games WHERE {earlier} GROUP BY ALL)"
    worth = _values([(_q(t), v) for t, v in cat.SCORE_TABLE.items()])
    by_game = "SELECT CASE game_uuid WHEN '' THEN url ELSE game_uuid END AS key, any_value(game_uuid) AS game_uuid, any_value(pgn) AS pgn FROM games GROUP BY 1"
    by_row = ("SELECT game_uuid AS key, game_uuid, any_value(pgn) AS pgn FROM games WHERE game_uuid <> '' GROUP BY ALL "
              "UNION ALL SELECT 'row ' || row_number() OVER (), game_uuid, pgn FROM games WHERE game_uuid = ''")

    return {
        "q_clean_games": cleaned + "SELECT * EXCLUDE (pgn) FROM games",
        "q_local_time": of_games("game_uuid", "username", "end_time_integer", "end_time", "end_time_date", "end_time_month"),
        "q_orient_result": of_games("game_uuid", "username", "playing_as", "playing_result_detailed", "playing_result",
                                    "playing_rating", "opponent_rating"),
        "q_moves_winprob": cleaned + "SELECT " + _rounded(
            ["game_uuid", "move_number", "move", "score_white", "player_color_turn", "score_black", "win_probability_white",
             "win_probability_black"], ("win_probability_white", "win_probability_black")) + " FROM games_moves",
        "q_clock_seconds": cleaned + "SELECT * FROM games_times",
        "q_scope_recent": model(cat.PS) + "SELECT game_uuid, username, end_time_date, time_class, rated FROM scoped",
        "q_alias_merge": cleaned + f"""SELECT game_uuid, coalesce(shown, s.username) AS username, white_username, black_username
FROM scoped s LEFT JOIN (SELECT * FROM {alias} a(account, shown)) ON lower(account) = lower(s.username)""",
        "q_clock_ratio": of_plies("move_number", "player_color_turn", "time_remaining_seconds", "prct_time_remaining"),
        "q_bands": of_plies("move_number", "game_phase", "playing_rating", "playing_rating_range", "opponent_rating",
                            "opponent_rating_range"),
        "q_score_swing": of_plies("move_number", "is_playing_turn", "playing_turn_name", "score_playing",
                                  "win_probability_playing", "prev_score_playing", "variance_score_playing"),
        "q_miss_playing": of_plies("move_number", "miss_category_playing", "miss_move_number_playing",
                                   "massive_blunder_move_number_playing"),
        "q_miss_opponent": of_plies("move_number", "miss_category_opponent", "miss_move_number_opponent"),
        "q_position_status": of_plies("move_number", "position_status_playing", "prev_position_status_playing"),
        "q_miss_context": of_plies("move_number", "miss_category_playing", "miss_context_playing"),
        "q_first_massive_side": plies + "SELECT DISTINCT game_uuid, username, first_blunder_playing_turn_name FROM games_with_moves",
        "q_games_with_moves": plies + f"SELECT {_rounded(GWM_COLUMNS, ply_rounded)} FROM games_with_moves",
        "q_keyless_kept": cleaned + f"""SELECT s.game_uuid, username, url, m.move_number, m.move, m.player_color_turn,
  m.player_color_turn = playing_as AS is_playing_turn,
  m.score_white * map {{'White': 1, 'Black': -1}}[playing_as] AS score_playing, playing_rating_range
FROM scoped s, games_moves m WHERE m.game_uuid = s.game_uuid""",
        "q_keyless_swings": model(cat.PKS) + f""", pair AS (
  SELECT username, url, m.move_number, m.move, m.player_color_turn AS colour, m.player_color_turn = playing_as AS own,
         m.score_white * map {{'White': 1, 'Black': -1}}[playing_as] AS score, m.score_white,
         CASE WHEN m.move_number <= len(regexp_extract_all(pgn, {_q(CLOCK_MARK_PATTERN)})) THEN 3600 - 20 * m.move_number + 0.5 END AS clock
  FROM scoped s, games_moves m WHERE m.game_uuid = '' AND s.game_uuid = ''
), told AS (
  SELECT *, lag(score) OVER of_player AS before, row_number() OVER of_player AS i FROM pair
  WINDOW of_player AS (PARTITION BY username ORDER BY move_number, url, move, score_white)
), judged AS (
  SELECT *, (SELECT max_by(name, loss) FROM miss WHERE CASE WHEN own THEN before - score ELSE score - before END >= loss
    AND (NOT contested OR (CASE WHEN own THEN before ELSE -before END > -{cat.PKS.balanced_limit}
                           AND CASE WHEN own THEN score ELSE -score END < {cat.PKS.balanced_limit}))) AS fault FROM told
)
SELECT username, url, move_number, move, score AS score_playing, before AS prev_score_playing, score - before AS variance_score_playing,
  {_status('before', cat.PKS)} AS prev_position_status_playing, CASE WHEN own THEN fault END AS miss_category_playing,
  CASE WHEN NOT own THEN fault END AS miss_category_opponent,
  CASE WHEN own AND fault <> 'Mistake' THEN map {{'Even': 'Throw', 'Disadvantage': 'Throw', 'Advantage': 'Missed Opportunity'}}[
    {_status('before', cat.PKS)}] END AS miss_context_playing,
  min_by(CASE WHEN own THEN 'Playing Turn' ELSE 'Opponent Turn' END, i) FILTER (fault = 'Massive Blunder') OVER (PARTITION BY username)
    AS first_blunder_playing_turn_name,
  round(clock / min_by(clock, i) OVER (PARTITION BY username, colour), {R}) AS prct_time_remaining
FROM judged""",
        "q_clock_join": _with(st, f"""
loaded AS (
  SELECT * FROM stg_games UNION ALL
  SELECT * REPLACE (replace(pgn, '.5]}}', '.7]}}') AS pgn) FROM stg_games WHERE end_time_integer // 86400 % 5 = 0
)""", _lookups(P), _games(P).replace("FROM stg_games", "FROM loaded")) + """SELECT s.game_uuid, s.username, s.url, m.move_number, m.move,
  t.time_remaining_seconds, score AS score_playing
FROM scoped s JOIN games_moves m ON m.game_uuid = s.game_uuid
LEFT JOIN games_times t ON t.game_uuid = s.game_uuid AND t.username = s.username AND t.move_number = m.move_number,
LATERAL (SELECT m.score_white * map {'White': 1, 'Black': -1}[playing_as] AS score)
WHERE s.game_uuid <> ''""",
        "q_agg_levels": whole_agg,
        "q_agg_phase_pivot": of_agg(*[c for c in AGG_COLUMNS(P) if c.startswith("nb_")]),
        "q_agg_clock_min": of_agg(*agg_rounded[1:]),
        "q_agg_stats": of_agg("median_score_playing", "max_score_playing", "min_score_playing", "std_score_playing"),
        "q_agg_string": of_agg("massive_blunder_move_number_playing"),
        "q_decisive": of_agg("nb_moves_above_decisive_advantage", "max_score_playing", "max_score_playing_range",
                             "max_score_playing_type"),
        "q_enough_games": of_agg("time_class", "end_time_month", "opponent_rating_range", "has_enough_games",
                                 sql=model(cat.PE, _plies(cat.PE), _agg(cat.PE))),
        "q_games_only": whole_agg + " WHERE aggregation_level = 'Games'",
        "q_player_rates": bench + "SELECT * FROM mine",
        "q_avg_median": bench + f"""SELECT username, time_class, playing_rating_range, game_phase_key, aggregation_level,
  round(avg(median_score_playing), {R}) AS avg_median_score_playing
FROM equals WHERE end_time_date >= {_months_before(PB, PB.benchmark_window_months)} GROUP BY ALL""",
        "q_score_sketches": agg + f"""SELECT {', '.join('a.' + k for k in level_keys)}, count(score_playing) AS nb_scores,
  count(DISTINCT {_near('score_playing')}) AS nb_buckets,
  {_near('quantile_disc(score_playing, 0.5)')} AS near_median_score_playing,
  CASE WHEN count(score_playing) > 0 THEN true END AS within_bound
FROM agg_games a JOIN levelled l ON l.level = aggregation_level AND l.username = a.username AND l.game_uuid = a.game_uuid
  AND l.game_phase IS NOT DISTINCT FROM a.game_phase
GROUP BY ALL""",
        "q_score_quantiles": bench + f"""SELECT e.username, e.time_class, e.playing_rating_range, game_phase_key, aggregation_level,
  count(score_playing) AS nb_scores,
  {', '.join(f"{_near(f'quantile_disc(score_playing, {q})')} AS score_p{round(100 * q)}" for q in (0.25, 0.5, 0.75))}
FROM equals e JOIN levelled l ON l.level = aggregation_level AND l.username = e.username AND l.game_uuid = e.game_uuid
  AND l.game_phase IS NOT DISTINCT FROM e.game_phase
WHERE e.end_time_date >= {_months_before(PB, PB.benchmark_window_months)} GROUP BY ALL""",
        "q_cohort": bench + "SELECT * FROM against",
        "q_frequent_range": bench + "SELECT * FROM favourite",
        "q_benchmark": bench + """SELECT a.* FROM against a WHERE (username, time_class, playing_rating_range) IN (
  SELECT (username, time_class, most_relevant_playing_rating_range) FROM favourite)""",
        "q_sample_grid": plies + f""", recent AS (
  SELECT DISTINCT game_uuid, username, time_class, playing_result, opponent_rating_range, url, end_time, playing_as
  FROM games_with_moves WHERE end_time_date >= {week}
), sampled AS (
  SELECT game_uuid, username, move_number, score_playing FROM games_with_moves WHERE move_number IN ({grid})
), latest AS (
  SELECT game_uuid, username, max_by(score_playing, move_number) AS score FROM sampled WHERE score_playing IS NOT NULL GROUP BY ALL
)
SELECT recent.*, CAST(g.n AS BIGINT) AS move_number, coalesce(score_playing, score) AS score_playing
FROM recent CROSS JOIN unnest([{grid}]) g(n)
LEFT JOIN sampled s ON s.game_uuid = recent.game_uuid AND s.username = recent.username AND s.move_number = g.n
LEFT JOIN latest t ON t.game_uuid = recent.game_uuid AND t.username = recent.username""",
        "q_audit": model(PB, _plies(PB)) + _audit(PB, *cat.AUDIT_SUBJECT),
        "q_audit_sets": model(cat.PA, _plies(cat.PA)) + " UNION ALL ".join(
            f"SELECT {_q(u)} AS username, {_q(c)} AS time_class, {_q(r)} AS playing_rating_range, a.* FROM ({_audit(cat.PA, u, c, r)}) a"
            for u, c, r in cat.AUDIT_SUBJECTS),
        "q_not_null": checks + "SELECT * FROM nulls",
        "q_move_consistency": checks + "SELECT * FROM off_span",
        "q_completeness": checks + "SELECT * FROM off_count",
        "q_keyless_report": checks + "SELECT * FROM keyless",
        "q_quality_report": checks + f"""SELECT check_name, failures,
  CASE WHEN failures > {P.error_if} THEN 'error' WHEN failures > {P.warn_if} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT concat_ws('_', 'not_null', model, column_name) AS check_name, failures FROM nulls
  UNION ALL SELECT 'keyless_' || model, failures FROM keyless
  UNION ALL SELECT 'assert_move_number_consistency', count(*) FROM off_span
  UNION ALL SELECT 'assert_stockfish_processing', count(*) FROM off_count)""",
        "q_high_water": _with(st) + ("SELECT username, max(archive_url) AS latest_archive_url, "
                                     "max(end_time_integer) AS latest_end_time FROM stg_games GROUP BY ALL"),
        "q_archive_filter": _with(st, seen) + f"""SELECT DISTINCT username, archive_url FROM stg_games LEFT JOIN seen USING (username)
WHERE archive_url >= coalesce(url, '') AND archive_url[-7:] >= {_q(cat.ARCHIVE_MIN_MONTH)}""".replace("coalesce(url", "coalesce(seen.url"),
        "q_new_games": _with(st, seen) + """SELECT game_uuid, username, end_time_integer FROM stg_games
LEFT JOIN seen USING (username) WHERE end_time_integer > coalesce(mark, 0)""",
        "q_unscored": _with(st) + f"""SELECT game_uuid, max(username) AS username, any_value(end_time_integer) AS end_time_integer
FROM stg_games
WHERE pgn <> '' AND rules = 'chess' AND game_uuid <> '' AND game_uuid NOT IN (
  SELECT game_uuid FROM stg_moves WHERE game_uuid IN (SELECT game_uuid FROM stg_games WHERE {earlier}))
GROUP BY game_uuid""",
        "q_plies": cleaned + f""", text AS MATERIALIZED ({by_row}), {_printed("FROM text SELECT key, pgn")},
read AS (
  SELECT game_uuid, coalesce(moves, []) AS moves, list_transform(regexp_extract_all(pgn, {_q(CLOCK_MARK_PATTERN)}), lambda m:
    list_sum(list_transform([1, 2, 3], lambda i: CAST(string_split(regexp_extract(m, 'clk ([^]]+)', 1), ':')[i] AS DOUBLE) * [3600, 60, 1][i]))) AS secs
  FROM text LEFT JOIN printed USING (key)
)
SELECT game_uuid, i AS move_number, moves[i] AS move, secs[i] AS time_remaining_seconds
FROM (SELECT *, unnest(range(1, greatest(len(moves), len(secs)) + 1)) AS i FROM read)""",
        "q_score_hook": cleaned + f""", {_printed(by_game)},
token AS (SELECT key, unnest(moves) AS move, unnest(range(1, len(moves) + 1)) AS n FROM printed)
SELECT key AS game_uuid, n AS move_number, t.move, CAST(sum(coalesce(w.v, 0) * CASE n % 2 WHEN 1 THEN 1 ELSE -1 END)
  OVER (PARTITION BY key ORDER BY n) AS BIGINT) AS score_white
FROM token t LEFT JOIN {worth} w(move, v) ON w.move = t.move""",
        "q_quarantine_games": _with(st, _damaged()) + f"""SELECT * EXCLUDE (archive, nth, line, kind, place, size) REPLACE (
  {_q(ARCHIVE_BASE)} || username || '/games/' || archive_url[-7:] AS archive_url, '2001-11-05 06:30:00' AS bq_load_date,
  rated AND kind <> {cat.MISSING_FIELDS} AS rated, CASE WHEN kind <> {cat.MISSING_FIELDS} THEN time_class ELSE '' END AS time_class,
  CASE WHEN kind <> {cat.MISSING_FIELDS} THEN rules ELSE '' END AS rules), '20011105_0630' AS load_ts
FROM dealt WHERE NOT (kind = {cat.CUT_OFF} AND place = size) AND NOT (kind IN ({cat.BAD_FIELD}, {cat.NO_OBJECT}) AND place = 1)""",
        "q_quarantine_accounts": _with(st, _damaged()) + f""", spoilt AS (SELECT username, archive, line, kind, any_value(size) AS size FROM dealt GROUP BY ALL)
SELECT username, archive, CAST(count(*) + count(*) FILTER (kind = {cat.NOT_JSON}) AS BIGINT) AS lines,
  CAST(count(*) FILTER (kind IN ({cat.CUT_OFF}, {cat.NOT_JSON})) AS BIGINT) AS broken_lines, CAST(sum(size) AS BIGINT) AS games_read,
  CAST(sum(size) - count(*) FILTER (kind IN ({cat.CUT_OFF}, {cat.BAD_FIELD}, {cat.NO_OBJECT})) AS BIGINT) AS games_kept,
  count(*) FILTER (kind = {cat.NOT_JSON}) AS rejected_line, count(*) FILTER (kind = {cat.CUT_OFF}) AS rejected_fragment,
  count(*) FILTER (kind = {cat.NO_OBJECT}) AS rejected_element, count(*) FILTER (kind = {cat.BAD_FIELD}) AS rejected_field,
  count(*) FILTER (kind IN ({cat.CUT_OFF}, {cat.BAD_FIELD}, {cat.NOT_JSON}, {cat.NO_OBJECT})) AS rejects_stored
FROM spoilt GROUP BY ALL""",
        "q_ingest_stream": _with(st) + f"""SELECT * EXCLUDE (bq_load_date) REPLACE (
  {_q(ARCHIVE_BASE)} || username || '/games/' || archive_url[-7:] AS archive_url) FROM stg_games WHERE end_time_integer > 0""",
        "q_published_loads": _with(st) + f"""SELECT * REPLACE (
  {_q(ARCHIVE_BASE)} || username || '/games/' || archive_url[-7:] AS archive_url, {_q(f'{cat.LOAD_TIME}')} AS bq_load_date),
  {_q(f'{cat.LOAD_TIME:%Y%m%d_%H%M}')} AS load_ts, CAST(CASE WHEN {earlier} THEN 1 ELSE 2 END AS BIGINT) AS load_no
FROM stg_games WHERE end_time_integer > 0""",
        "q_published_marks": _with(st) + f"""SELECT username, {_q(ARCHIVE_BASE)} || username || '/games/' || max(archive_url[-7:]) AS latest_archive_url,
  max(end_time_integer) AS latest_end_time
FROM stg_games WHERE end_time_integer > 0 GROUP BY username""",
    }
