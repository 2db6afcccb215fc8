import pytest
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.silver import clean_odds, clean_plays, dedupe, map_values
from tests.fixtures import TEAM_MAP, bronze_odds, bronze_plays


def test_clean_plays_types_filter_dedupe(spark):
    silver = clean_plays(bronze_plays(spark), dedupe_order=("epa",))
    rows = {(r.game_id, r.play_id): r for r in silver.collect()}
    assert ("g1", "5") not in rows                      # kickoff filtered out
    assert ("g1", "4") in rows                          # rush kept
    assert len([k for k in rows if k == ("g1", "2")]) == 1
    assert rows[("g1", "2")].epa == pytest.approx(0.10)  # ordered survivor: smallest epa
    assert rows[("g1", "1")].yards_gained == 5           # "5.0" -> 5
    assert rows[("g1", "3")].yards_gained is None        # "NA" -> null
    assert rows[("g1", "3")].epa is None                 # "NaN" -> null
    assert rows[("g1", "4")].yards_gained is None        # empty -> null
    assert rows[("g2", "1")].is_playoffs == 1            # null season type
    assert rows[("g1", "1")].is_playoffs == 0
    assert rows[("g1", "1")].home_margin == 3
    assert str(rows[("g1", "1")].game_date) == "2020-09-11"
    assert dict(silver.dtypes)["season"] == "int" and dict(silver.dtypes)["epa"] == "double"


def test_literal_keep_types_drop_run(spark):
    silver = clean_plays(bronze_plays(spark), keep_types=schemas.LITERAL_KEEP_TYPES, dedupe_order=("epa",))
    assert silver.where(F.col("play_type") == "run").count() == 0


def test_dedupe_keeps_one_row_per_key_under_skew(spark):
    hot = [("g", "1", i) for i in range(2000)] + [("h", "1", 5)]
    df = spark.createDataFrame(hot, "game_id string, play_id string, v int").repartition(8)
    out = dedupe(df, order_by=("v",)).orderBy("game_id").collect()
    assert [(r.game_id, r.v) for r in out] == [("g", 0), ("h", 5)]


def test_map_values_dict_and_frame(spark):
    df = spark.createDataFrame([("Team A",), ("Nobody",)], "t string")
    lit = map_values(df, ["t"], TEAM_MAP).collect()
    frame = map_values(df, ["t"], spark.createDataFrame(list(TEAM_MAP.items()), "team_name string, team_code string")).collect()
    assert sorted(r.t for r in lit) == sorted(r.t for r in frame) == ["A", "Nobody"]


def test_clean_odds(spark):
    odds = clean_odds(bronze_odds(spark), TEAM_MAP, after=2019, last_regular=None).collect()
    assert len(odds) == 4                                   # 2019 dropped
    by_week = {(r.week, r.home_team): r for r in odds}
    assert (18, "A") in by_week and (18, "Unknown Name") in by_week   # Wildcard -> 18 collides with week 18
    assert by_week[(1, "A")].is_favorite_home == 1
    assert by_week[(2, "B")].is_favorite_home == 0          # null favourite
    assert by_week[(2, "B")].over_under_line is None        # blank line
    assert by_week[(18, "A")].over_under_line == 41.5
    own = {(r.week, r.home_team) for r in clean_odds(bronze_odds(spark), TEAM_MAP, after=2020 - 1).collect()}
    assert own == {(1, "A"), (2, "B"), (18, "A"), (18, "Unknown Name")}   # 2020 has 17 regular weeks


def test_dedupe_order_is_total(spark):
    """The survivor does not depend on the layout; an order by keys alone is refused."""
    rows = [("g", "1", i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "game_id string, play_id string, v int, w int")
    layouts = [df, df.orderBy(F.desc("w")).coalesce(1), df.repartition(13, "w")]
    assert {tuple(dedupe(x, order_by=("v",)).first()) for x in layouts} == {("g", "1", 0, 0)}
    assert {tuple(dedupe(x).first()) for x in layouts} == {("g", "1", 0, 0)}
    with pytest.raises(ValueError, match="ties"):
        dedupe(df, order_by=("play_id",))
