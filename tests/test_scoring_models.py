import pytest
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.features import feature_matrix, select_features
from gridcast.operators.metrics import accuracy, chrono_split, confusion_matrix, evaluate, mae
from gridcast.operators.models import fit_home_win, fit_margin, fit_total, load_model, save_model
from gridcast.operators.scoring import (latest_team_game, market_edges, matchup_features,
                                        score_matchups)
from gridcast.operators.silver import clean_plays
from gridcast.plans.gold import build_gold
from tests.fixtures import bronze_plays


@pytest.fixture
def gold(spark):
    return build_gold(clean_plays(bronze_plays(spark), dedupe_order=("epa",)), None)


def test_market_edges_rules(spark):
    rows = [(0.7, 5.3, 50.0, 2.0, 45.0), (0.3, -4.0, 40.0, 0.0, 45.0), (0.5, 1.0, 45.0, 0.5, 44.0),
            (0.61, -0.7, 47.1, -3.0, 45.0)]
    df = spark.createDataFrame(rows, "prob_home_win double, pred_spread double, pred_total double, vegas_spread double, vegas_total double")
    out = [r.recommendations for r in market_edges(df).collect()]
    assert out[0] == [schemas.LABEL_BET_HOME, schemas.LABEL_SPREAD_PREFIX + "+5", schemas.LABEL_OVER]
    assert out[1] == [schemas.LABEL_BET_AWAY, schemas.LABEL_OPPOSITE_SPREAD, schemas.LABEL_UNDER]
    assert out[2] == [schemas.LABEL_NO_EDGE]
    assert out[3] == [schemas.LABEL_BET_HOME, schemas.LABEL_SPREAD_PREFIX + "0", schemas.LABEL_OVER]


def test_latest_and_matchup_modes(spark, gold):
    latest = {r.team: r for r in latest_team_game(gold).collect()}
    assert latest["A"].game_id == "g4" and latest["A"].is_home is False
    req = spark.createDataFrame([("A", "C", -2.5, 44.0), ("LAR", "A", 3.0, 40.0)],
                                "home_team string, away_team string, vegas_spread double, vegas_total double")
    own = {r.home_team: r for r in matchup_features(req, latest_team_game(gold), "own_side").collect()}
    lit = {r.home_team: r for r in matchup_features(req, latest_team_game(gold), "literal").collect()}
    g4 = gold.where(F.col("game_id") == "g4").first()
    assert own["A"].home_points_scored_season_avg == g4.away_points_scored_season_avg   # A was away in g4
    assert lit["A"].home_points_scored_season_avg == g4.home_points_scored_season_avg   # literal (Q4)
    assert own["A"].is_favorite_home == 1 and own["LAR"].is_favorite_home == 0
    assert own["LAR"].home_points_scored_season_avg is None                              # unknown team


def test_features_and_metrics(spark, gold):
    feats = select_features(gold)
    assert "avg_epa_per_play" not in feats and len(feats) == 36
    fm = feature_matrix(gold, feats)
    assert fm.where(F.col("home_points_scored_season_avg").isNull()).count() == 0
    df = spark.createDataFrame([("train", 1, 1, 3.0, 1.0), ("train", 0, 1, 1.0, 2.0), ("test", 1, 0, 0.0, 0.5)],
                               "split string, y int, p int, a double, b double")
    acc = {r.split: r.accuracy for r in accuracy(df, "y", "p", by=("split",)).collect()}
    assert acc == {"train": 0.5, "test": 0.0}
    assert {r.split: r.mae for r in mae(df, "a", "b", by=("split",)).collect()} == {"train": 1.5, "test": 0.5}
    cm = {(r.split, r.actual): (r.predicted_away, r.predicted_home)
          for r in confusion_matrix(df, "y", "p", by=("split",)).collect()}
    assert cm[("train", 0)] == (0, 1) and cm[("train", 1)] == (0, 1) and cm[("test", 1)] == (1, 0)


def test_models_fit_save_load_score(spark, gold, tmp_dir):
    data = chrono_split(gold, train_to=2020, val=2021)
    feats = select_features(gold)
    win = fit_home_win(data, feats, max_iter=2, depth=2)
    spread = fit_margin(data, feats, max_iter=2, depth=2)
    total = fit_total(data, feats, max_iter=2, depth=2)
    save_model(win, f"{tmp_dir}/win")
    win2 = load_model(f"{tmp_dir}/win")
    req = spark.createDataFrame([("A", "C", -2.5, 44.0)], "home_team string, away_team string, vegas_spread double, vegas_total double")
    out = score_matchups(req, gold, win2, spread, total).collect()
    assert len(out) == 1 and 0.0 <= out[0].prob_home_win <= 1.0 and out[0].recommendations
