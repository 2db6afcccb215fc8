"""Home/away reshaping and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas


def _pick(cond, value, what: str) -> F.Column:
    """The value of the single row meeting ``cond`` in the group.  A second such
    row fails the job lazily (no extra pass): a pivot must not silently pick one."""
    n = F.count_if(cond)
    return F.when(n > 1, F.raise_error(F.lit(f"side_pivot: more than one {what} row per game"))) \
        .otherwise(F.max(F.when(cond, value)))


DEFENSE_SIDES = ("own", "as_row")


def side_rows(entity: str, defense_side: str = "own") -> dict[str, F.Column]:
    """Whether a team-game row is the home or the away side's, for the metrics of an entity:
    two flags that say all that the pivot asks of the teams."""
    who = entity if defense_side == "own" else "posteam"
    return {f"_{side}_row": F.col(who) == F.col(f"{side}_team") for side in ("home", "away")}


def side_pivot(form: DataFrame, metrics: Sequence[schemas.RollingMetric] = schemas.ALL_METRICS,
               defense_side: str = "own") -> DataFrame:
    """Two team-game rows per game -> one row per game with ``home_*``/``away_*``
    trailing columns (J1).

    One conditional aggregate by ``game_id`` instead of filtering the form table
    twice and self-joining: one shuffle, partial aggregation, no duplicated
    window work.

    ``defense_side="own"`` reads a side's defence columns from the row where
    that side defends (``defteam = home_team`` for home), so ``home_def_*``
    describes the home defence.  ``"as_row"`` reads them from the side's own
    offence row, as the original pipeline did, which yields the opponent's
    defence (quirk Q2).

    A table of one entity may come with the flags of ``side_rows`` in place of the teams.
    """
    if defense_side not in DEFENSE_SIDES:
        raise ValueError("defense_side must be 'own' or 'as_row'")
    flagged = {c: F.col(c) for c in form.columns if c in ("_home_row", "_away_row")}
    aggs = []
    for side in ("home", "away"):
        for m in metrics:
            row = (flagged or side_rows(m.entity, defense_side))[f"_{side}_row"]
            for frame, (team_suffix, gold_suffix) in schemas.FRAMES.items():
                aggs.append(_pick(row, F.col(f"{m.name}_{team_suffix}"), f"{side} {m.entity}")
                            .alias(f"{side}_{m.name}_{gold_suffix}"))
    return form.groupBy("game_id").agg(*aggs)


def attach_form(base: DataFrame, sides: DataFrame) -> DataFrame:
    """Game base LEFT JOIN the pivoted form on ``game_id`` (J2): a game with no
    possession rows keeps nulls."""
    return base.join(sides, "game_id", "left")


def unique_odds(odds: DataFrame, on: Sequence[str] = schemas.ODDS_KEYS) -> DataFrame:
    """One odds row per join key; a repeated key fails the job lazily.

    A partial+final aggregate on the key (collapses copies map-side), so the
    check costs no extra pass over the data.
    """
    others = [c for c in odds.columns if c not in on]
    n = F.count(F.lit(1))
    guard = F.when(n > 1, F.raise_error(F.lit("attach_odds: odds key is not unique (week collision?)")))
    return odds.groupBy(*on).agg(
        *[guard.otherwise(F.first(c)).alias(c) for c in others])


def attach_odds(games: DataFrame, odds: DataFrame, on: Sequence[str] = schemas.ODDS_KEYS,
                check_unique: bool = True) -> DataFrame:
    """Games LEFT JOIN market lines on (season, week, home_team, away_team).

    With ``check_unique`` the odds side is reduced to one row per key and the
    job fails if a key repeats, so the join can never add rows.  Without it a
    repeated key fans a game out into several rows (quirk Q3).  The join
    strategy is left to Spark: the odds side is broadcast when its measured
    size is below the broadcast threshold, otherwise sort-merge.
    """
    side = unique_odds(odds, on) if check_unique else odds
    return games.join(side, list(on), "left")


def unpivot_counts(wide: DataFrame, name_col: str = "column_name",
                   value_col: str = "null_count") -> DataFrame:
    """One wide row of counts -> (column_name, count) rows (R1); columns of any name."""
    return wide.unpivot([], [F.col(f"`{c}`") for c in wide.columns], name_col, value_col)
