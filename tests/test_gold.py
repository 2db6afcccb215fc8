import pytest
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.aggregate import game_base, team_game_stats
from gridcast.operators.reshape import attach_odds, side_pivot
from gridcast.operators.rolling import team_form
from gridcast.operators.silver import clean_odds, clean_plays
from gridcast.plans.gold import GoldOptions, build_gold
from tests.fixtures import TEAM_MAP, bronze_odds, bronze_plays


@pytest.fixture
def silver(spark):
    return clean_plays(bronze_plays(spark), dedupe_order=("epa",))


def test_game_base(spark, silver):
    g = {r.game_id: r for r in game_base(silver).collect()}
    assert g["g1"].final_home_score == 13 and g["g1"].final_away_score == 10
    assert g["g1"].home_win == 1 and g["g2"].home_win == 0      # tie -> 0
    assert g["g1"].total_rush_plays == 2                          # run + rush (repaired Q1)
    assert g["g1"].total_offensive_yards == 8                     # 5 + 3 + null + null


def test_team_game_stats(spark, silver):
    tg = {(r.game_id, r.posteam): r for r in team_game_stats(silver).collect()}
    assert ("g2", "A") not in tg                                  # A never has the ball in g2
    assert tg[("g1", "A")].team_plays == 3
    assert tg[("g1", "A")].off_final_points_scored == 13
    assert tg[("g1", "B")].off_final_points_scored == 10
    assert tg[("g1", "B")].rush_yds == 0


def test_side_pivot_modes_swap_defence(spark, silver):
    form = team_form(team_game_stats(silver), strategy="window")
    own = {r.game_id: r for r in side_pivot(form, defense_side="own").collect()}
    lit = {r.game_id: r for r in side_pivot(form, defense_side="as_row").collect()}
    g = "g3"
    for frame in ("last_4_games_avg", "season_avg"):
        assert own[g][f"home_def_allowed_{frame}"] == lit[g][f"away_def_allowed_{frame}"]
        assert own[g][f"home_points_scored_{frame}"] == lit[g][f"home_points_scored_{frame}"]


def test_gold_row_per_game_and_odds(spark, silver):
    odds = clean_odds(bronze_odds(spark), TEAM_MAP, after=2019)
    gold = build_gold(silver, odds)
    assert gold.count() == gold.select("game_id").distinct().count() == 4
    g1 = gold.where(F.col("game_id") == "g1").first()
    assert g1.spread_favorite == -3.5 and g1.is_favorite_home == 1
    assert g1.home_points_scored_season_avg is None               # first game of the season


def test_unique_odds_check_fails_on_duplicate_key(spark, silver):
    odds = clean_odds(bronze_odds(spark), TEAM_MAP, after=2019)
    dup = odds.unionByName(odds.limit(1))
    with pytest.raises(Exception, match="not unique"):
        attach_odds(game_base(silver), dup).collect()
    fan = attach_odds(game_base(silver), dup, check_unique=False)
    assert fan.count() == 5                                        # literal reading fans out (Q3)


def test_literal_options(spark):
    silver = clean_plays(bronze_plays(spark), keep_types=schemas.LITERAL_KEEP_TYPES, dedupe_order=("epa",))
    gold = build_gold(silver, None, GoldOptions.literal(strategy="window"))
    assert gold.agg(F.sum("total_rush_plays")).first()[0] == 1   # only the "rush" play counts


def test_input_order_and_partitioning_change_nothing(spark):
    """Property (d): exact sums make gold independent of row order and partitioning."""
    bronze = bronze_plays(spark)
    a = build_gold(clean_plays(bronze, dedupe_order=("epa",)), None, GoldOptions(strategy="window"))
    shuffled = bronze.orderBy(F.rand(5)).repartition(7)
    b = build_gold(clean_plays(shuffled, dedupe_order=("epa",)), None, GoldOptions(strategy="scan"))
    rows = lambda df: sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()),
                             key=lambda t: tuple(repr(x) for x in t))
    assert rows(a) == rows(b)


def test_wildcard_and_week_18_of_one_pairing_keep_their_lines(spark):
    """In a season of 18 weeks the Wildcard game of a pairing that also met in week 18
    has week 19; each game gets its own line (Q3)."""
    from tests.fixtures import play
    rows = [play("1", "w18", 2022, 18, "A", "B", "A", "B", "pass", "5", "0.1", "7", "3", date="2023-01-08"),
            play("1", "wc", 2022, 19, "A", "B", "A", "B", "pass", "5", "0.1", "7", "3", date="2023-01-15", season_type="POST")]
    plays = spark.createDataFrame([tuple(r[c] for c in schemas.BRONZE_PLAY_COLUMNS) for r in rows], schemas.BRONZE_PLAYS)
    odds = spark.createDataFrame([(2022, "18", "Team A", "Team B", "A", -3.0, "40"), (2022, "Wildcard", "Team A", "Team B", "A", -9.0, "41")],
                                 schemas.BRONZE_ODDS)
    gold = build_gold(clean_plays(plays), clean_odds(odds, TEAM_MAP))
    assert {r.game_id: r.spread_favorite for r in gold.collect()} == {"w18": -3.0, "wc": -9.0}
    literal = clean_odds(odds, TEAM_MAP, last_regular=None)
    assert [r.week for r in literal.collect()] == [18, 18]
