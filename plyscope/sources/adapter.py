"""Shape the driver tables (lineitem ⋈ supplier ⋈ nation ⋈ region) like the two staging tables.

A game is (supplier, ship year); a ply is a line item, ordered by ship date and the line keys.
The tracked player is the supplier's region name. Definitions: FIXTURES.md §4. The same rules are
written as SQL in ``plyscope.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.params import STANDARD_INITIAL_SETUP

# Fixed values of the adapter (FIXTURES.md §4).
TIME_CLASSES_BY_SUPPKEY = ("blitz", "rapid", "bullet", "daily")
TIME_CONTROL_BY_CLASS = {"blitz": "180", "rapid": "600", "bullet": "60", "daily": "1/86400"}
# (white_result, black_result) by (suppkey + year) % 4
RESULTS_BY_CODE = (("win", "checkmated"), ("resigned", "win"), ("stalemate", "stalemate"), ("win", "timeout"))
OPPONENT = "opp"
LOAD_DATE = "2001-11-04 00:00:00"
LOAD_TS = "20011104_0000"
URL_PREFIX = "https://example.invalid/"
# Seeded special cases: {name: (modulus, remainder)} of the supplier key; FIXTURES.md §4.
CASES = {
    "last_ply_unscored": (13, 5), "ply_scored_twice": (17, 3), "unscored": (19, 7), "no_white_rating": (11, 4),
    "other_rules": (23, 6), "custom_setup": (23, 9), "standard_setup": (23, 10), "no_text": (29, 8),
    "two_players": (7, 2), "black_unnumbered": (5, 1), "no_clocks": (9, 4), "side_unknown": (37, 14),
    "calm": (6, 0), "quiet": (8, 4), "side_lines": (12, 7),
}
# A side line as deep as the ply number says, with a parenthesis inside a comment at each level.
SIDE_LINE = "(XX {a ) b} "
KEYLESS_SUPPLIER = 12
CUSTOM_SETUP = "8/8/8/8/8/8/8/8 w - - 0 1"
PLY_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def _case(name: str):
    modulus, remainder = CASES[name]
    return F.col("l_suppkey") % modulus == remainder


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds_ntz(c):
    """Epoch seconds of a TIMESTAMP_NTZ read as UTC, independent of the session zone."""
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400
            + F.hour(c).cast("bigint") * 3600 + F.minute(c).cast("bigint") * 60 + F.second(c).cast("bigint"))


def game_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game with its line items in ply order (the shared adapter base): what its games and its plies are
    derived from row by row, so that line items are shuffled once, without the text made of them."""
    item = F.struct(*PLY_ORDER, F.concat("l_returnflag", "l_linestatus").alias("move"), "l_quantity")
    items = (_read(spark, sf_dir, "lineitem").filter(F.col("l_suppkey").isNotNull())
             .select("l_suppkey", F.year("l_shipdate").cast("bigint").alias("y"), item.alias("item"))
             .repartition("l_suppkey", "y").groupBy("l_suppkey", "y").agg(F.sort_array(F.collect_list("item")).alias("items"))
             .select("l_suppkey", "y", F.array_max(F.transform("items", lambda i: i["l_shipdate"])).alias("end_ntz"),
                     F.transform("items", lambda i: F.struct(i["move"].alias("move"), i["l_quantity"].alias("l_quantity"))).alias("items")))
    # supplier → region name; the optimizer broadcasts what is small enough.
    who = (_read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
           .join(_read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                 F.col("s_nationkey") == F.col("n_nationkey"))
           .join(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("s_suppkey", "r_name"))
    # a supplier key that is there several times has a list, and a line item of it is a ply for each entry
    seats = who.groupBy("s_suppkey").agg(F.sort_array(F.collect_list(F.struct("r_name"))).alias("seats"))
    return (items.join(seats, items.l_suppkey == seats.s_suppkey).drop("s_suppkey")
            .withColumn("game_uuid", F.when(F.col("l_suppkey") == KEYLESS_SUPPLIER, F.lit("")).otherwise(
                F.concat(F.lit("g-"), F.col("l_suppkey").cast("string"), F.lit("-"), F.col("y").cast("string")))))


def with_plies(games: DataFrame) -> DataFrame:
    """``game_items`` with its numbered plies: array<struct<r_name, move_number, move, l_quantity>>."""
    every = F.flatten(F.transform("items", lambda i: F.transform("seats", lambda s: F.struct(
        s["r_name"].alias("r_name"), i["move"].alias("move"), i["l_quantity"].alias("l_quantity")))))
    return games.withColumn("every", every).withColumn("plies", F.transform("every", lambda p, i: F.struct(
        p["r_name"].alias("r_name"), (i + 1).cast("bigint").alias("move_number"), p["move"].alias("move"),
        p["l_quantity"].alias("l_quantity")))).drop("items", "every")


def _ply_text(move_number, move):
    n = ((move_number + 1) / 2).cast("bigint")  # (move_number + 1) div 2
    secs = F.lit(3600) - F.lit(20) * move_number
    mm = F.lpad((secs / 60).cast("bigint").cast("string"), 2, "0")
    ss = F.lpad((secs % 60).cast("string"), 2, "0")
    prefix = F.when(move_number % 2 == 1, F.concat(n.cast("string"), F.lit(". "))) \
        .when(_case("black_unnumbered"), F.lit("")).otherwise(F.concat(n.cast("string"), F.lit("... ")))
    clock = F.when(_case("no_clocks"), F.lit(" ")).otherwise(F.concat(F.lit(" {[%clk 0:"), mm, F.lit(":"), ss, F.lit(".5]} ")))
    depth = (move_number / 10).cast("int") + 1
    side_line = F.when(_case("side_lines") & (move_number % 10 == 0), F.concat(
        F.repeat(F.lit(SIDE_LINE), depth), F.repeat(F.lit(")"), depth), F.lit(" "))).otherwise(F.lit(""))
    return F.concat(prefix, move, clock, side_line)


def staging_moves_from(games: DataFrame) -> DataFrame:
    """The scored plies: some games are unscored, lack their last ply or have a ply twice."""
    p = with_plies(games).select("game_uuid", "l_suppkey", F.size("plies").alias("__last"), F.explode("plies").alias("p")).select(
        "game_uuid", "l_suppkey", "__last", "p.*")
    score = (F.col("l_quantity").cast("int") * 40 - 1020) / F.when(_case("calm"), 20).when(_case("quiet"), 4).otherwise(1)
    kept = p.filter(
        ~_case("unscored") & ~(_case("last_ply_unscored") & (F.col("move_number") == F.col("__last"))))
    times = F.when(_case("ply_scored_twice") & (F.col("move_number") == 2), 2).otherwise(1)
    return kept.select(
        "game_uuid", "move_number", "move",
        score.cast("bigint").alias("score_white"), F.explode(F.sequence(F.lit(1), times)).alias("__t")).drop("__t")


def staging_games_from(games: DataFrame) -> DataFrame:
    """One row per game and player (move text in ply order, end = last ship date)."""
    players = F.when(_case("two_players"), F.array("r_name", F.lit(OPPONENT))).otherwise(F.array("r_name"))
    g = (with_plies(games).withColumn("seat", F.explode(F.array_distinct("seats"))).withColumn("r_name", F.col("seat.r_name"))
         .withColumn("ply_texts", F.transform(F.filter("plies", lambda s: s["r_name"].eqNullSafe(F.col("r_name"))),
                                              lambda s: _ply_text(s["move_number"], s["move"])))
         .drop("plies", "seats", "seat").withColumn("player", F.explode(players)))
    k = F.col("l_suppkey")
    white_is_player = (k % 2 == 0)
    tclass = F.element_at(F.array(*[F.lit(x) for x in TIME_CLASSES_BY_SUPPKEY]), (k % 4 + 1).cast("int"))
    code = ((k + F.col("y")) % 4 + 1).cast("int")
    wres = F.element_at(F.array(*[F.lit(w) for w, _ in RESULTS_BY_CODE]), code)
    bres = F.element_at(F.array(*[F.lit(b) for _, b in RESULTS_BY_CODE]), code)
    tc_map = F.create_map(*[F.lit(x) for kv in TIME_CONTROL_BY_CLASS.items() for x in kv])
    return g.select(
        F.concat(F.lit(URL_PREFIX), F.col("player"), F.lit("/games/"),
                 F.date_format("end_ntz", "yyyy/MM")).alias("archive_url"),
        F.col("player").alias("username"),
        F.lit(LOAD_DATE).alias("bq_load_date"),
        F.concat(F.lit(URL_PREFIX + "game/"), k.cast("string"), F.lit("-"), F.col("y").cast("string")).alias("url"),
        F.when(_case("no_text"), F.lit("")).otherwise(
            F.array_join("ply_texts", "")).alias("pgn"),
        F.element_at(tc_map, tclass).alias("time_control"),
        _epoch_seconds_ntz(F.col("end_ntz")).alias("end_time_integer"),
        (k % 10 != 0).alias("rated"),
        F.lit("").alias("tcn"),
        F.col("game_uuid"),
        F.when(_case("custom_setup"), F.lit(CUSTOM_SETUP)).when(_case("standard_setup"), F.lit(STANDARD_INITIAL_SETUP))
         .otherwise(F.lit("")).alias("initial_setup"),
        F.lit("").alias("fen"),
        tclass.alias("time_class"),
        F.when(_case("other_rules"), F.lit("chess960")).otherwise(F.lit("chess")).alias("rules"),
        F.when(_case("side_unknown"), F.lit("guest")).when(white_is_player, F.col("r_name"))
         .otherwise(F.lit(OPPONENT)).alias("white_username"),
        F.when(~_case("no_white_rating"), (F.lit(350) + (k * 37 % 9) * 200).cast("bigint")).alias("white_rating"),
        wres.alias("white_result"),
        F.lit("").alias("white_id"),
        F.lit("").alias("white_uuid"),
        F.when(_case("side_unknown"), F.lit("visitor")).when(white_is_player, F.lit(OPPONENT))
         .otherwise(F.col("r_name")).alias("black_username"),
        (F.lit(350) + ((k * 37 + (F.col("y") + 1) % 2) % 9) * 200).cast("bigint").alias("black_rating"),
        bres.alias("black_result"),
        F.lit("").alias("black_id"),
        F.lit("").alias("black_uuid"),
    )


def staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(staging games, staging moves) from the driver tables; both share one plan of a game's items."""
    g = game_items(spark, sf_dir)
    return staging_games_from(g), staging_moves_from(g)


def staging_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_games_from(game_items(spark, sf_dir))


def staging_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_moves_from(game_items(spark, sf_dir))


def land_staging(spark: SparkSession, sf_dir: str, base: str) -> tuple[str, str]:
    """Write the two staging tables derived from the driver tables under ``base`` (the load step).

    The games' items are written once and both tables are derived from them without another shuffle.
    """
    game_items(spark, sf_dir).write.mode("overwrite").parquet(f"{base}/items")
    written = spark.read.parquet(f"{base}/items")
    staging_games_from(written).write.mode("overwrite").parquet(f"{base}/games")
    staging_moves_from(written).write.mode("overwrite").parquet(f"{base}/moves")
    return f"{base}/games", f"{base}/moves"
