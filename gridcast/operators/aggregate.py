"""Game-level and team-game aggregates (A1, A2).

Both are single hash aggregates: partial aggregation runs map-side, so only one
small row per (task, group) crosses the shuffle even when one game holds a large
share of the plays.  Where both are wanted the plays are aggregated once, to a
rollup of a few rows per game (``play_rollup``), and each is an aggregate of that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.functions.columns import decimal_to_double, exact, exact_avg, exact_sum
from gridcast.operators.silver import filter_has_possession


def _count_when(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def game_base(plays: DataFrame, pass_types: Sequence[str] = schemas.PASS_TYPES,
              rush_types: Sequence[str] = schemas.RUSH_TYPES) -> DataFrame:
    """One row per game with targets and same-game totals (A1a-A1g)."""
    pt = F.col("play_type")
    home_final = F.max("total_home_score")
    away_final = F.max("total_away_score")
    offensive = pt.isin(list(pass_types) + list(rush_types))
    return plays.groupBy(*schemas.GAME_KEYS).agg(
        home_final.alias("final_home_score"),
        away_final.alias("final_away_score"),
        (home_final + away_final).alias("final_total_score"),
        F.max("home_margin").alias("final_home_margin"),
        F.when(home_final > away_final, 1).otherwise(0).alias("home_win"),
        _count_when(pt.isin(list(pass_types))).alias("total_pass_plays"),
        _count_when(pt.isin(list(rush_types))).alias("total_rush_plays"),
        F.sum(F.when(offensive, F.col("yards_gained")).otherwise(0)).alias("total_offensive_yards"),
        exact_avg("epa").alias("avg_epa_per_play"),
    )


def team_game_stats(plays: DataFrame, pass_types: Sequence[str] = schemas.PASS_TYPES,
                    rush_types: Sequence[str] = schemas.RUSH_TYPES) -> DataFrame:
    """One row per game and offence: EPA, yards, plays, points scored (P10, A2a-A2d)."""
    pt = F.col("play_type")
    return filter_has_possession(plays).groupBy(*schemas.TEAM_GAME_KEYS).agg(
        exact_avg("epa").alias("off_epa_avg"),
        F.sum(F.when(pt.isin(list(pass_types)), F.col("yards_gained")).otherwise(0)).alias("pass_yds"),
        F.sum(F.when(pt.isin(list(rush_types)), F.col("yards_gained")).otherwise(0)).alias("rush_yds"),
        F.sum("yards_gained").alias("total_yds"),
        F.count("play_id").alias("team_plays"),
        F.max(_own_points()).alias("off_final_points_scored"),
    )


# --- both from one pass over the plays ----------------------------------------

#: Keys of the rollup: those of a game and the two sides of a play.
ROLLUP_KEYS = (*schemas.GAME_KEYS, "posteam", "defteam")


def play_rollup(plays: DataFrame, pass_types: Sequence[str] = schemas.PASS_TYPES, count_rush_types: Sequence[str] = schemas.RUSH_TYPES,
                yard_rush_types: Sequence[str] = schemas.RUSH_TYPES) -> DataFrame:
    """Mergeable sums, counts and maxima by game and side with the ball (null: nobody's),
    from which :func:`game_base_of` and :func:`team_games_of` follow."""
    pt, yards = F.col("play_type"), F.col("yards_gained")
    passes, counted, rushed = (pt.isin(list(t)) for t in (pass_types, count_rush_types, yard_rush_types))
    return plays.groupBy(*ROLLUP_KEYS).agg(
        F.max("total_home_score").alias("home_score"), F.max("total_away_score").alias("away_score"), F.max("home_margin").alias("margin"),
        _count_when(passes).alias("n_pass"), _count_when(counted).alias("n_rush"),
        F.sum(F.when(passes | counted, yards).otherwise(0)).alias("offensive_yards"),
        exact_sum("epa").alias("epa_sum"), F.count(exact("epa")).alias("epa_n"),
        F.sum(F.when(passes, yards).otherwise(0)).alias("pass_yds"), F.sum(F.when(rushed, yards).otherwise(0)).alias("rush_yds"),
        F.sum(yards).alias("total_yds"), F.count("play_id").alias("n_plays"),
        F.max(_own_points()).alias("own_points"))


def _own_points() -> F.Column:
    return (F.when(F.col("posteam") == F.col("home_team"), F.col("total_home_score"))
            .when(F.col("posteam") == F.col("away_team"), F.col("total_away_score")).otherwise(0))


def _merged_avg(total: str, count: str) -> F.Column:
    n = F.sum(count)
    return F.when(n > 0, decimal_to_double(F.try_sum(total)) / n.cast("double"))


def game_base_of(rollup: DataFrame) -> DataFrame:
    """``game_base`` of the plays behind a rollup."""
    home, away = F.max("home_score"), F.max("away_score")
    return rollup.groupBy(*schemas.GAME_KEYS).agg(
        home.alias("final_home_score"), away.alias("final_away_score"), (home + away).alias("final_total_score"),
        F.max("margin").alias("final_home_margin"), F.when(home > away, 1).otherwise(0).alias("home_win"),
        F.sum("n_pass").alias("total_pass_plays"), F.sum("n_rush").alias("total_rush_plays"),
        F.sum("offensive_yards").alias("total_offensive_yards"), _merged_avg("epa_sum", "epa_n").alias("avg_epa_per_play"))


def team_games_of(rollup: DataFrame) -> DataFrame:
    """``team_game_stats`` of the plays behind a rollup."""
    return filter_has_possession(rollup).groupBy(*schemas.TEAM_GAME_KEYS).agg(
        _merged_avg("epa_sum", "epa_n").alias("off_epa_avg"), F.sum("pass_yds").alias("pass_yds"), F.sum("rush_yds").alias("rush_yds"),
        F.sum("total_yds").alias("total_yds"), F.sum("n_plays").alias("team_plays"), F.max("own_points").alias("off_final_points_scored"))
