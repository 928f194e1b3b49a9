"""The full table build over the driver tables (sf0.001) and cross-table properties."""

import os

import pytest
from pyspark.sql import functions as F

from plyscope import catalog, pipeline
from plyscope.params import ADAPTER_PARAMS
from plyscope.sources import ingest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipeline"))
    sg, sm = catalog._staging(spark, SF)
    ingest.append_snapshot(sg, f"{base}/games", "20011104_0000")
    ingest.append_snapshot(sm, f"{base}/moves", "20011104_0000")
    paths = pipeline.run_from_snapshots(spark, f"{base}/games", f"{base}/moves", f"{base}/out", ADAPTER_PARAMS)
    return {k: spark.read.parquet(v) for k, v in paths.items()}


def test_tables_written(built):
    assert set(built) == set(pipeline.TABLES)
    assert len(built["games_with_moves"].columns) == 41
    assert len(built["agg_games_with_moves"].columns) == 42
    assert len(built["agg_games_benchmark"].columns) == 21
    assert len(built["games_with_moves_only_recent"].columns) == 10


def test_phase_counts_sum_to_game_counts(built):
    a = built["agg_games_with_moves"]
    games = a.filter("aggregation_level = 'Games'").select("username", "game_uuid", "nb_moves", "nb_blunder_playing",
                                                           "nb_massive_blunder_playing")
    phases = (a.filter("aggregation_level = 'Game Phases'").groupBy("username", "game_uuid")
              .agg(F.sum("nb_moves").alias("m"), F.sum("nb_blunder_playing").alias("b"),
                   F.sum("nb_massive_blunder_playing").alias("mb")))
    bad = games.join(phases, ["username", "game_uuid"]).filter(
        "m != nb_moves OR b != nb_blunder_playing OR mb != nb_massive_blunder_playing")
    assert bad.count() == 0
    assert a.filter("nb_massive_blunder_playing > nb_blunder_playing").count() == 0
    assert a.filter("nb_throw_playing + nb_missed_opportunity_playing > nb_blunder_playing").count() == 0


def test_games_only_and_grid(built):
    a, o, r = built["agg_games_with_moves"], built["agg_games_with_moves_only_games"], \
        built["games_with_moves_only_recent"]
    assert o.count() == a.filter("aggregation_level = 'Games'").count() > 0
    per_game = r.groupBy("username", "game_uuid").count()
    assert per_game.filter("count != 13").count() == 0 and per_game.count() > 0


def test_data_tests_find_the_seeded_cases(built):
    rows = {x.check_name: (x.failures, x.status) for x in built["data_tests"].collect()}
    assert rows["assert_move_number_consistency"][0] > 0
    assert rows["assert_stockfish_processing"][1] == "error"
    assert rows["not_null_games_username"] == (0, "pass")


def test_rates_in_unit_interval(built):
    b = built["agg_games_benchmark"]
    rate_cols = [c for c in b.columns if "rate_" in c]
    assert rate_cols
    for c in rate_cols:
        assert b.filter(f"{c} < 0 OR {c} > 1").count() == 0
