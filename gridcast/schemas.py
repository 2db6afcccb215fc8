"""Schemas of every layer, metric lists and the fixed values the pipeline must share
with the original scripts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for the same results)
# ---------------------------------------------------------------------------

# Play types kept in silver by the original cleaner.  Note it keeps "rush" and
# drops "run" (quirk Q1); the repaired default below keeps both.
LITERAL_KEEP_TYPES = ("pass", "rush", "punt", "field_goal", "extra_point")
PASS_TYPES = ("pass",)
RUSH_TYPES = ("run", "rush")
KEEP_TYPES = ("pass", "run", "rush", "punt", "field_goal", "extra_point")

# Odds file: playoff round names and the week numbers the original assigns them.
LITERAL_WEEK_NAMES = {"Wildcard": 18, "Division": 19, "Conference": 20, "Superbowl": 21}
# Last regular week from a season on (public schedule: 17 weeks, 18 from 2021).
LAST_REGULAR_WEEK = {0: 17, 2021: 18}

# Odds file: full team names -> team codes (33 entries, two names for Washington).
TEAM_NAME_TO_CODE = {
    "San Francisco 49ers": "SF",
    "Tennessee Titans": "TEN",
    "Houston Texans": "HOU",
    "Jacksonville Jaguars": "JAX",
    "Arizona Cardinals": "ARI",
    "Tampa Bay Buccaneers": "TB",
    "New England Patriots": "NE",
    "Kansas City Chiefs": "KC",
    "Buffalo Bills": "BUF",
    "Indianapolis Colts": "IND",
    "Philadelphia Eagles": "PHI",
    "Cleveland Browns": "CLE",
    "New York Jets": "NYJ",
    "Chicago Bears": "CHI",
    "Miami Dolphins": "MIA",
    "Atlanta Falcons": "ATL",
    "Green Bay Packers": "GB",
    "Carolina Panthers": "CAR",
    "Denver Broncos": "DEN",
    "Dallas Cowboys": "DAL",
    "Los Angeles Chargers": "LAC",
    "Las Vegas Raiders": "LV",
    "New Orleans Saints": "NO",
    "Detroit Lions": "DET",
    "Los Angeles Rams": "LA",
    "Seattle Seahawks": "SEA",
    "Baltimore Ravens": "BAL",
    "Pittsburgh Steelers": "PIT",
    "Minnesota Vikings": "MIN",
    "Cincinnati Bengals": "CIN",
    "New York Giants": "NYG",
    "Washington Commanders": "WAS",
    "Washington Football Team": "WAS",
}

# Page code -> odds/gold code aliases (quirk Q9).
TEAM_ALIASES = {"LAR": "LA"}

# Market-edge rule thresholds and labels.
WIN_HI = 0.60
WIN_LO = 0.40
SPREAD_GAP = 1.5
TOTAL_GAP = 2.0
LABEL_BET_HOME = "🏆 BET HOME"
LABEL_BET_AWAY = "🏆 BET AWAY"
LABEL_SPREAD_PREFIX = "📈 BET "
LABEL_OPPOSITE_SPREAD = "📉 BET OPPOSITE SPREAD"
LABEL_OVER = "🔢 BET OVER"
LABEL_UNDER = "🔢 BET UNDER"
LABEL_NO_EDGE = "⚖️ NO CLEAR EDGE"

# Chronological split and boosted-tree settings.
TRAIN_TO_SEASON = 2022
VAL_SEASON = 2023
GBT_MAX_ITER = 500
GBT_MAX_DEPTH = 6
GBT_STEP_SIZE = 0.1
GBT_SUBSAMPLE = 0.8
GBT_SEED = 42
TOP_IMPORTANCES = 15
RECENT_GAMES = 4

# ---------------------------------------------------------------------------
# Layer schemas
# ---------------------------------------------------------------------------

# Bronze play-by-play: every used column is text.  Unlisted columns of a real
# file pass through untouched when read with header inference off.
BRONZE_PLAY_COLUMNS = (
    "play_id", "game_id", "game_date", "season", "week", "season_type",
    "home_team", "away_team", "posteam", "defteam", "play_type",
    "air_yards", "yards_after_catch", "yards_gained", "epa",
    "total_home_score", "total_away_score", "div_game", "result", "wp",
)
BRONZE_PLAYS = T.StructType([T.StructField(c, T.StringType(), True) for c in BRONZE_PLAY_COLUMNS])

# Silver casts: text column -> target type.
PLAY_INT_COLUMNS = (
    "season", "week", "air_yards", "yards_after_catch", "yards_gained",
    "total_home_score", "total_away_score", "div_game",
)
PLAY_DOUBLE_COLUMNS = ("epa",)

# Columns profiled by the exploratory summary.
SUMMARY_COLUMNS = ("play_id", "game_id", "game_date", "season", "week", "home_team", "away_team",
                   "posteam", "defteam", "play_type", "yards_gained", "epa", "wp")

BRONZE_ODDS = T.StructType([
    T.StructField("schedule_season", T.IntegerType(), True),
    T.StructField("schedule_week", T.StringType(), True),
    T.StructField("team_home", T.StringType(), True),
    T.StructField("team_away", T.StringType(), True),
    T.StructField("team_favorite_id", T.StringType(), True),
    T.StructField("spread_favorite", T.DoubleType(), True),
    T.StructField("over_under_line", T.StringType(), True),
])

GAME_KEYS = ("game_id", "season", "game_date", "week", "home_team", "away_team",
             "div_game", "is_playoffs")
TEAM_GAME_KEYS = ("game_id", "season", "week", "posteam", "defteam", "home_team", "away_team")
ODDS_KEYS = ("season", "week", "home_team", "away_team")
ODDS_FEATURES = ("is_favorite_home", "spread_favorite", "over_under_line")


# ---------------------------------------------------------------------------
# Trailing-form metrics
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class RollingMetric:
    """One trailing average: ``name`` over ``source`` (negated when ``negate``),
    partitioned by ``entity`` (the offence ``posteam`` or the defence ``defteam``)."""

    name: str
    source: str
    entity: str
    negate: bool = False


OFFENSE_METRICS = (
    RollingMetric("off_epa", "off_epa_avg", "posteam"),
    RollingMetric("team_plays", "team_plays", "posteam"),
    RollingMetric("points_scored", "off_final_points_scored", "posteam"),
    RollingMetric("pass_yds", "pass_yds", "posteam"),
    RollingMetric("rush_yds", "rush_yds", "posteam"),
)
DEFENSE_METRICS = (
    RollingMetric("def_epa", "off_epa_avg", "defteam", negate=True),
    RollingMetric("def_allowed", "off_final_points_scored", "defteam"),
    RollingMetric("def_allowed_pass_yds", "pass_yds", "defteam"),
    RollingMetric("def_allowed_rush_yds", "rush_yds", "defteam"),
)
ALL_METRICS = OFFENSE_METRICS + DEFENSE_METRICS

# Frame name -> (team-game column suffix, gold column suffix)
FRAMES = {"recent": ("recent_avg", "last_4_games_avg"), "season": ("season_avg", "season_avg")}


def team_form_columns(metrics=ALL_METRICS) -> list[str]:
    return [f"{m.name}_{FRAMES[f][0]}" for m in metrics for f in FRAMES]


def gold_form_columns(side: str, metrics=ALL_METRICS) -> list[str]:
    return [f"{side}_{m.name}_{FRAMES[f][1]}" for m in metrics for f in FRAMES]
