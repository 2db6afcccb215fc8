"""Silver -> gold: one row per game with trailing form of both sides and market lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.aggregate import game_base_of, play_rollup, team_games_of
from gridcast.operators.reshape import attach_form, attach_odds, side_pivot, side_rows, unique_odds
from gridcast.operators.rolling import DEFAULT_ORDER, add_trailing_avg, by_entity
from gridcast.session import materialize


@dataclass(frozen=True)
class GoldOptions:
    """Knobs of the gold build.  Defaults are the repaired readings; ``literal()``
    gives the original pipeline's reading of every quirk."""

    pass_types: Sequence[str] = schemas.PASS_TYPES
    count_rush_types: Sequence[str] = schemas.RUSH_TYPES   # game-level rush play count
    yard_rush_types: Sequence[str] = schemas.RUSH_TYPES    # team-game rush yards
    recent: int = schemas.RECENT_GAMES
    order: Sequence[str] = DEFAULT_ORDER
    defense_side: str = "own"
    check_unique_odds: bool = True
    strategy: str = "scan"
    metrics: Sequence[schemas.RollingMetric] = field(default=schemas.ALL_METRICS)

    @staticmethod
    def literal(**overrides) -> "GoldOptions":
        """The original reading: rush plays counted as ``rush`` but rush yards summed
        over ``run`` (Q1), defence columns taken from the side's offence row (Q2),
        no odds key check (Q3)."""
        base = dict(count_rush_types=("rush",), yard_rush_types=("run",),
                    defense_side="as_row", check_unique_odds=False)
        base.update(overrides)
        return GoldOptions(**base)


def game_form(team_games: DataFrame, opts: GoldOptions = GoldOptions(), wanted: DataFrame | None = None) -> DataFrame:
    """Trailing form and pivot (W1-W4, J1): one row per game.  Each entity's form is worked
    out and pivoted by itself, from the columns that it needs, so that no pass moves the
    other's averages; the pivots have the same games and meet where their game is.  Form
    follows from all games; ``wanted`` says which of them to pivot."""
    parts = []
    for entity, ms in by_entity(opts.metrics).items():
        # what the pivot asks of a row: its game and whose side it is; no team goes along
        sides = side_rows(entity, opts.defense_side)
        form = add_trailing_avg(team_games.withColumns(sides), ms, opts.recent, opts.order, strategy=opts.strategy, columns=("game_id", *sides))
        parts.append(side_pivot(_of(wanted, form), ms, opts.defense_side))
    games = reduce(lambda a, b: a.join(b, "game_id"), parts)
    return games.select("game_id", *[c for side in ("home", "away") for c in schemas.gold_form_columns(side, opts.metrics)])


def _of(wanted: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The rows of the wanted games (a table of ``game_id``; None: all)."""
    if wanted is None:
        return rows
    ids = wanted.select(F.col("game_id").alias("_wanted"))
    return rows.join(ids, F.col("game_id").eqNullSafe(F.col("_wanted")), "left_semi")


def build_gold(plays: DataFrame, odds: DataFrame | None, opts: GoldOptions = GoldOptions(),
               choose: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Silver plays (+ silver odds) -> gold games.

    The plays are aggregated once, to a rollup by game and side, which is written in
    the shared folder, bucketed by game: what follows reads these few rows a game, and the
    team-games written from them, as often as it needs to, and games and team-games stay
    where they are; a lost executor costs a read of them.  The odds are written as well,
    so Spark knows their size before it plans the join.

    ``choose`` gets the game base and returns the games that are asked for: their form is
    that of the whole table's games, but only they are pivoted, joined and returned.
    """
    rollup = materialize(play_rollup(plays, opts.pass_types, opts.count_rush_types, opts.yard_rush_types), "rollup", by="game_id")
    # the trailing form reads the team-games several times, in few columns
    base, tg = game_base_of(rollup), materialize(team_games_of(rollup), "team_games")
    wanted = None if choose is None else materialize(choose(base).select("game_id").distinct(), "wanted")
    base, sides = _of(wanted, base), game_form(tg, opts, wanted)
    if odds is None:
        return attach_form(base, sides)
    # both joins keep every game, so their order is free: the odds go to the narrow rows,
    # and the wide ones stay where the pivot left them
    known = materialize(unique_odds(odds) if opts.check_unique_odds else odds, "odds")
    games = attach_form(attach_odds(base, known, check_unique=False), sides)
    lines = [c for c in odds.columns if c not in schemas.ODDS_KEYS]
    return games.select(*schemas.ODDS_KEYS, *[c for c in games.columns if c not in (*schemas.ODDS_KEYS, *lines)], *lines)
