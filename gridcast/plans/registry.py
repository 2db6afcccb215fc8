"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the
stand-in reading of the driver's tables; ``ORACLE`` holds the DuckDB text of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import schemas
from gridcast.operators.aggregate import game_base, team_game_stats
from gridcast.operators.rolling import rolling_defense, rolling_offense, team_form
from gridcast.operators.silver import clean_odds, clean_plays
from gridcast.plans import oracle as O
from gridcast.plans.gold import GoldOptions, build_gold, game_form
from gridcast.session import held, materialize
from gridcast.sources import standin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

DEDUPE_ORDER = ("src_seq",)


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Normalise -0.0 to 0.0 in double columns (values themselves are exact)."""
    return df.select([(F.col(f.name) + F.lit(0.0)).alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                      for f in df.schema.fields])


# --- shared stand-in stages --------------------------------------------------

def silver_plays(spark: SparkSession, sf_dir: str, keep_types=schemas.KEEP_TYPES) -> DataFrame:
    return clean_plays(standin.plays(spark, sf_dir), keep_types, dedupe_order=DEDUPE_ORDER)


def silver_odds(spark: SparkSession, sf_dir: str, week_names=standin.STANDIN_WEEK_NUMBERS,
                last_regular=None) -> DataFrame:
    return clean_odds(standin.odds(spark, sf_dir), standin.team_map(spark, sf_dir),
                      after=standin.STANDIN_AFTER, week_names=week_names, last_regular=last_regular)


def team_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team-game stats as a written table, which the trailing form reads several times."""
    return materialize(team_game_stats(silver_plays(spark, sf_dir)), "team_games")


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest game of every team as a written table of a row per team: what matchups
    are joined to has no lineage behind it.  Which games those are follows from the game
    base; gold has their rows, a few a team, with form from all games."""
    games = build_gold(silver_plays(spark, sf_dir), silver_odds(spark, sf_dir), choose=latest_team_game)
    return materialize(latest_team_game(materialize(games, "gold")), "latest")


def gold(spark: SparkSession, sf_dir: str, opts: GoldOptions = GoldOptions()) -> DataFrame:
    return build_gold(silver_plays(spark, sf_dir), silver_odds(spark, sf_dir), opts)


def gold_oracle_ctes(keep_types=schemas.KEEP_TYPES, week_names=standin.STANDIN_WEEK_NUMBERS,
                     count_rush=schemas.RUSH_TYPES, yard_rush=schemas.RUSH_TYPES,
                     defense_side="own") -> list[str]:
    return [O.STANDIN_CTES, O.plays_clean_cte(keep_types), O.odds_clean_cte(week_names),
            O.game_base_cte(rush_types=count_rush), O.team_games_cte(rush_types=yard_rush),
            O.team_form_cte(), O.side_pivot_cte(defense_side), """
gold as (
  select * from game_base left join side_pivot using (game_id)
  left join odds_clean using (season, week, home_team, away_team)
)"""]


GOLD_INT = O.GAME_BASE_INT + schemas.ODDS_KEYS + ("is_favorite_home",)
GOLD_DOUBLE = (("avg_epa_per_play",) + tuple(schemas.gold_form_columns("home"))
               + tuple(schemas.gold_form_columns("away")) + ("spread_favorite", "over_under_line"))
GOLD_COLUMNS = tuple(dict.fromkeys(O.GAME_BASE_INT + ("avg_epa_per_play",)
                                   + GOLD_DOUBLE[1:] + ("is_favorite_home",)))


def gold_select(source: str = "gold") -> str:
    return f"select {O.round_list(GOLD_COLUMNS, ints=GOLD_INT)} from {source}"


# --- silver ------------------------------------------------------------------

@register("plays_clean", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte())
          + f" select {O.PLAYS_CLEAN_COLUMNS} from plays_clean")
def q_plays_clean(spark, sf_dir):
    """Bronze plays -> typed, filtered, de-duplicated silver plays."""
    return rounded(silver_plays(spark, sf_dir))


@register("odds_clean", O.with_ctes(O.STANDIN_CTES, O.odds_clean_cte(schemas.LITERAL_WEEK_NAMES))
          + " select * from odds_clean")
def q_odds_clean(spark, sf_dir):
    """Bronze odds -> silver odds with the original week numbering."""
    return rounded(silver_odds(spark, sf_dir, schemas.LITERAL_WEEK_NAMES))


# --- gold stages ---------------------------------------------------------------

@register("game_base", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.game_base_cte())
          + f" select {O.round_list(O.GAME_BASE_INT + ('avg_epa_per_play',), ints=O.GAME_BASE_INT)}"
            " from game_base")
def q_game_base(spark, sf_dir):
    """A1: one row per game, targets and same-game totals."""
    return rounded(game_base(silver_plays(spark, sf_dir)))


@register("team_game_stats", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.team_games_cte())
          + f" select {O.round_list(O.TEAM_GAME_COLUMNS + ('off_epa_avg',), ints=O.TEAM_GAME_COLUMNS)}"
            " from team_games")
def q_team_game_stats(spark, sf_dir):
    """P10 A2: one row per game and offence."""
    return rounded(team_game_stats(silver_plays(spark, sf_dir)))


def _form_sql(metrics) -> str:
    cols = O.TEAM_GAME_COLUMNS + ("off_epa_avg",) + tuple(schemas.team_form_columns(metrics))
    return (O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.team_games_cte(),
                        O.team_form_cte(metrics))
            + f" select {O.round_list(cols, ints=O.TEAM_GAME_COLUMNS)} from team_form")


@register("rolling_offense", _form_sql(schemas.OFFENSE_METRICS))
def q_rolling_offense(spark, sf_dir):
    """Offence form over the last 4 games and the season to date."""
    return rounded(rolling_offense(team_games(spark, sf_dir)))


@register("rolling_defense", _form_sql(schemas.DEFENSE_METRICS))
def q_rolling_defense(spark, sf_dir):
    """Defence form (negated EPA, points and yards allowed)."""
    return rounded(rolling_defense(team_games(spark, sf_dir)))


@register("rolling_window_strategy", _form_sql(schemas.ALL_METRICS))
def q_rolling_window_strategy(spark, sf_dir):
    """W1-W4 with the plain-window strategy (same values as the scan)."""
    return rounded(team_form(team_games(spark, sf_dir), strategy="window"))


@register("rolling_scan_strategy", _form_sql(schemas.ALL_METRICS))
def q_rolling_scan_strategy(spark, sf_dir):
    """W1-W4 with the skew-proof parallel prefix scan (same values as the window)."""
    return rounded(team_form(team_games(spark, sf_dir), strategy="scan"))


def _pivot_sql(defense_side: str) -> str:
    cols = ["game_id"] + schemas.gold_form_columns("home") + schemas.gold_form_columns("away")
    return (O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.team_games_cte(), O.team_form_cte(),
                        O.side_pivot_cte(defense_side))
            + f" select {O.round_list(cols, ints=('game_id',))} from side_pivot")


@register("side_pivot_own", _pivot_sql("own"))
def q_side_pivot_own(spark, sf_dir):
    """One row per game; each side's defence columns describe its own defence."""
    return rounded(game_form(team_games(spark, sf_dir), GoldOptions(defense_side="own")))


@register("side_pivot_as_row", _pivot_sql("as_row"))
def q_side_pivot_as_row(spark, sf_dir):
    """J1 literal (Q2): defence columns read from the side's own offence row."""
    return rounded(game_form(team_games(spark, sf_dir), GoldOptions(defense_side="as_row")))


@register("gold_game_features", O.with_ctes(*gold_oracle_ctes()) + " " + gold_select())
def q_gold_game_features(spark, sf_dir):
    """Flagship: A1 A2 W1-W4 J1-J3 -> one row per game with both sides' form and odds."""
    return rounded(gold(spark, sf_dir).select(*GOLD_COLUMNS))


@register("gold_stored", O.with_ctes(*gold_oracle_ctes()) + " " + gold_select())
def q_gold_stored(spark, sf_dir):
    """The gold table as training and serving read it, written and read back."""
    from gridcast.sources.files import read_gold, write_layer
    path = _own_folder(spark, "gold_stored")
    write_layer(gold(spark, sf_dir), path, within=("game_id",))
    return rounded(read_gold(spark, path).select(*GOLD_COLUMNS))


@register("gold_literal_weeks", O.with_ctes(*gold_oracle_ctes(
    keep_types=schemas.LITERAL_KEEP_TYPES, week_names=schemas.LITERAL_WEEK_NAMES,
    count_rush=("rush",), yard_rush=("run",), defense_side="as_row")) + " " + gold_select())
def q_gold_literal_weeks(spark, sf_dir):
    """The original reading of every quirk: silver drops ``run`` (Q1), defence
    columns from the offence row (Q2), playoff weeks 18-21 collide with regular
    weeks and fan games out in the unchecked odds join (Q3)."""
    plays = silver_plays(spark, sf_dir, schemas.LITERAL_KEEP_TYPES)
    odds = silver_odds(spark, sf_dir, schemas.LITERAL_WEEK_NAMES)
    return rounded(build_gold(plays, odds, GoldOptions.literal()).select(*GOLD_COLUMNS))


# --- quality reports -------------------------------------------------------------

from gridcast.operators.quality import column_summary, layer_report, null_profile  # noqa: E402

_BRONZE_COLUMNS = ("play_id", "game_id", "game_date", "season", "week", "season_type", "home_team",
                   "away_team", "posteam", "defteam", "play_type", "air_yards", "yards_after_catch",
                   "yards_gained", "epa", "total_home_score", "total_away_score", "div_game", "result",
                   "src_seq")
_SILVER_COLUMNS = tuple(c.strip() for c in O.PLAYS_CLEAN_COLUMNS.split(","))


def _null_profile_sql(source: str, cols) -> str:
    parts = " union all ".join(
        f"select '{c}' as column_name, cast(count(*) filter (where {c} is null) as bigint) as null_count from {source}"
        for c in cols)
    return f"select * from ({parts}) where null_count > 0"


@register("null_profile", O.with_ctes(O.STANDIN_CTES) + " " + _null_profile_sql("fx_pbp", _BRONZE_COLUMNS))
def q_null_profile(spark, sf_dir):
    """Null counts per bronze column, non-zero only, largest first."""
    return null_profile(standin.plays(spark, sf_dir))


@register("null_profile_silver", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte()) + " "
          + _null_profile_sql("plays_clean", _SILVER_COLUMNS))
def q_null_profile_silver(spark, sf_dir):
    """A3 on silver plays: which casts produced nulls ("NA", empty text)."""
    return null_profile(silver_plays(spark, sf_dir))


def _summary_sql() -> str:
    parts = []
    for c in schemas.SUMMARY_COLUMNS:
        x = c if c in _BRONZE_COLUMNS else "cast(null as varchar)"
        num = f"try_cast({x} as double)"
        parts.append(
            f"select '{c}' as column_name, count({x}) as count, {O.exact_avg(num)} + 0.0 as mean, "
            f"round(stddev_samp({num}), 6) + 0.0 as stddev, min({x}) as min, max({x}) as max from fx_pbp")
    return O.with_ctes(O.STANDIN_CTES) + " " + " union all ".join(parts)


@register("column_summary", _summary_sql())
def q_column_summary(spark, sf_dir):
    """A4: count / mean / stddev / min / max of the profiled bronze columns."""
    return rounded(column_summary(standin.plays(spark, sf_dir), schemas.SUMMARY_COLUMNS))


@register("layer_report", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte())
          + f" select 'bronze' as layer, count(*) as n_rows, {len(_BRONZE_COLUMNS)} as n_columns from fx_pbp"
            f" union all select 'silver', count(*), {len(_SILVER_COLUMNS)} from plays_clean")
def q_layer_report(spark, sf_dir):
    """Rows and columns before and after cleaning."""
    return layer_report(standin.plays(spark, sf_dir), "bronze").unionByName(
        layer_report(silver_plays(spark, sf_dir), "silver"))


#: Columns of the stored silver layer in order, the partition column last (fixed values).
_STORED_TYPES = {
    "play_id": "string", "game_id": "string", "game_date": "date", "week": "int", "is_playoffs": "int", "home_team": "string",
    "away_team": "string", "posteam": "string", "defteam": "string", "play_type": "string", "air_yards": "int",
    "yards_after_catch": "int", "yards_gained": "int", "epa": "double", "total_home_score": "int", "total_away_score": "int",
    "div_game": "int", "home_margin": "int", "src_seq": "string", "season": "int"}


@register("stored_profile", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte()) + " " + " union all ".join(
    f"select 'silver' as layer, {i} as position, '{c}' as column_name, '{t}' as data_type, count(*) as n_rows,"
    f" count(*) - count({c}) as null_count from plays_clean" for i, (c, t) in enumerate(_STORED_TYPES.items(), 1)))
def q_stored_profile(spark, sf_dir):
    """A3 S7 on the written silver layer: schema, rows and nulls from file footers."""
    from gridcast.operators.quality import stored_profile
    from gridcast.sources.files import read_footers, write_layer
    path = _own_folder(spark, "stored_profile")
    write_layer(silver_plays(spark, sf_dir), path)
    return stored_profile(read_footers(spark, path), "silver")


# --- sinks and partitioned round trip ----------------------------------------------

@register("season_roundtrip", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte())
          + " select season, count(*) as n_plays, count(distinct game_id) as n_games"
            " from plays_clean group by season")
def q_season_roundtrip(spark, sf_dir):
    """Silver plays written partitioned by season (whole table, then one
    season restated in place), read back with partition discovery, counted."""
    from gridcast.sources.files import read_layer, write_layer, write_season
    path = _own_folder(spark, "season_roundtrip")
    plays = silver_plays(spark, sf_dir)
    write_layer(plays, path)
    last = read_layer(spark, path).agg(F.max("season")).first()[0]
    if last is not None:
        # restating one season must leave the others untouched
        write_season(plays.where(F.col("season") == last), path)
    return read_layer(spark, path).groupBy("season").agg(
        F.count(F.lit(1)).alias("n_plays"), F.count_distinct("game_id").alias("n_games"))


# --- features, splits and metrics ---------------------------------------------------

from gridcast.operators.features import feature_matrix, select_features  # noqa: E402
from gridcast.operators.metrics import (accuracy, chrono_split, confusion_matrix,  # noqa: E402
                                        evaluate, home_win_baseline, split_counts)
from gridcast.operators.scoring import (form_forecast, latest_team_game,  # noqa: E402
                                        market_edges, matchup_features)

_SPLIT_SQL = (f"case when season <= {standin.STANDIN_TRAIN_TO} then 'train' when season = {standin.STANDIN_VAL}"
              f" then 'val' when season > {standin.STANDIN_VAL} then 'test' end")


def split_gold(spark, sf_dir) -> DataFrame:
    return chrono_split(gold(spark, sf_dir), standin.STANDIN_TRAIN_TO, standin.STANDIN_VAL)


_GOLD = O.with_ctes(*gold_oracle_ctes(), f"""
gold_split as (select *, {_SPLIT_SQL} as split from gold)""")


@register("home_win_baseline", _GOLD + " select count(*) as n_games,"
          " cast(sum(home_win) as double) / count(home_win) as home_win_rate from gold")
def q_home_win_baseline(spark, sf_dir):
    """A5: home-win base rate over all games."""
    return home_win_baseline(gold(spark, sf_dir))


@register("split_counts", _GOLD + " select count(*) as n_all, count(*) filter (where split = 'train') as n_train,"
          " count(*) filter (where split = 'val') as n_val, count(*) filter (where split = 'test') as n_test"
          " from gold_split")
def q_split_counts(spark, sf_dir):
    """Chronological split sizes."""
    return split_counts(split_gold(spark, sf_dir))


FEATURES = [c for c in GOLD_COLUMNS if "_avg" in c] + list(schemas.ODDS_FEATURES)
_MATRIX_KEEP = ("game_id", "season", "home_win", "final_home_margin", "final_total_score")


@register("feature_matrix", _GOLD + " select " + ", ".join(
    list(_MATRIX_KEEP) + [f"coalesce({c}, 0) + 0.0 as {c}" if c != "is_favorite_home"
                          else f"coalesce({c}, 0) as {c}" for c in FEATURES]) + " from gold")
def q_feature_matrix(spark, sf_dir):
    """The 39 features (36 trailing averages + 3 odds), nulls as 0."""
    g = gold(spark, sf_dir)
    feats = select_features(g)
    assert feats == FEATURES, feats
    return rounded(feature_matrix(g, feats, _MATRIX_KEEP))


_LATEST_COLS = ("team", "is_home", "game_id", "game_date", "season", "week", "home_team", "away_team",
                "home_points_scored_season_avg", "away_points_scored_season_avg")
_LATEST_CTE = """
sides as (
  select home_team as team, true as is_home, * from gold
  union all select away_team as team, false as is_home, * from gold
),
latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by team order by game_date desc, game_id desc) as rn from sides)
  where rn = 1
)"""


@register("latest_team_game", O.with_ctes(*gold_oracle_ctes(), _LATEST_CTE)
          + f" select {O.round_list(_LATEST_COLS, ints=_LATEST_COLS[:8])} from latest")
def q_latest_team_game(spark, sf_dir):
    """Most recent game of every team, home or away."""
    return rounded(latest(spark, sf_dir).select(*_LATEST_COLS))


def _requests(spark, sf_dir) -> DataFrame:
    """Matchup requests derived from the data: every priced game of the odds table."""
    return silver_odds(spark, sf_dir).select(
        "season", "week", "home_team", "away_team",
        F.col("spread_favorite").alias("vegas_spread"), F.col("over_under_line").alias("vegas_total"))


_MATCHUP_KEYS = ("season", "week", "home_team", "away_team", "vegas_spread", "vegas_total")
_MATCHUP_FEATURES = tuple(FEATURES)


def _matchup_cte(mode: str) -> str:
    home = [c for c in FEATURES if c.startswith("home_")]
    away = [c for c in FEATURES if c.startswith("away_")]

    def pick(alias, c, side):
        stem = c[len(side) + 1:]
        if mode == "literal":
            return f"{alias}.{c} as {c}"
        return f"case when {alias}.is_home then {alias}.home_{stem} else {alias}.away_{stem} end as {c}"
    cols = [pick("lh", c, "home") for c in home] + [pick("la", c, "away") for c in away]
    return f"""
requests as (
  select season, week, home_team, away_team, spread_favorite as vegas_spread, over_under_line as vegas_total
  from odds_clean
),
matchups as (
  select r.*, {', '.join(cols)},
    cast(r.vegas_spread as double) as spread_favorite, cast(r.vegas_total as double) as over_under_line,
    case when r.vegas_spread < 0 then 1 else 0 end as is_favorite_home
  from requests r left join latest lh on r.home_team = lh.team left join latest la on r.away_team = la.team
)"""


def _matchup_sql(mode: str) -> str:
    cols = _MATCHUP_KEYS + _MATCHUP_FEATURES
    return (O.with_ctes(*gold_oracle_ctes(), _LATEST_CTE, _matchup_cte(mode))
            + f" select {O.round_list(cols, ints=_MATCHUP_KEYS[:4] + ('is_favorite_home',))} from matchups")


@register("matchup_features_literal", _matchup_sql("literal"))
def q_matchup_features_literal(spark, sf_dir):
    """T2 P15 (literal, Q4): home_* read from the home team's latest row as is."""
    feats = matchup_features(_requests(spark, sf_dir), latest(spark, sf_dir), "literal")
    return rounded(feats.select(*_MATCHUP_KEYS, *_MATCHUP_FEATURES))


@register("matchup_features_own", _matchup_sql("own_side"))
def q_matchup_features_own(spark, sf_dir):
    """T2 P15 (own side): each team's form from the side it actually played."""
    feats = matchup_features(_requests(spark, sf_dir), latest(spark, sf_dir), "own_side")
    return rounded(feats.select(*_MATCHUP_KEYS, *_MATCHUP_FEATURES))


def _forecast_sql(source: str) -> str:
    h = "coalesce(home_points_scored_season_avg, 0.0)"
    a = "coalesce(away_points_scored_season_avg, 0.0)"
    return f"""
forecast as (
  select *, case when {h} + {a} > 0 then {h} / ({h} + {a}) else 0.5 end as prob_home_win,
    {h} - {a} as pred_spread, {h} + {a} as pred_total
  from {source}
),
forecast2 as (select *, cast(prob_home_win > 0.5 as integer) as pred_home_win from forecast)"""


def _edges_sql() -> str:
    s = "pred_spread"
    win = (f"case when prob_home_win > {schemas.WIN_HI} then '{schemas.LABEL_BET_HOME}' "
           f"when prob_home_win < {schemas.WIN_LO} then '{schemas.LABEL_BET_AWAY}' end")
    spr = (f"case when {s} > vegas_spread + {schemas.SPREAD_GAP} then '{schemas.LABEL_SPREAD_PREFIX}' || "
           f"(case when {s} > 0 then '+' else '' end) || cast(cast(trunc({s}) as integer) as varchar) "
           f"when {s} < vegas_spread - {schemas.SPREAD_GAP} then '{schemas.LABEL_OPPOSITE_SPREAD}' end")
    tot = (f"case when pred_total > vegas_total + {schemas.TOTAL_GAP} then '{schemas.LABEL_OVER}' "
           f"when pred_total < vegas_total - {schemas.TOTAL_GAP} then '{schemas.LABEL_UNDER}' end")
    return f"coalesce(nullif(concat_ws('; ', {win}, {spr}, {tot}), ''), '{schemas.LABEL_NO_EDGE}')"


_EDGE_COLS = ("season", "week", "home_team", "away_team", "vegas_spread", "vegas_total",
              "prob_home_win", "pred_spread", "pred_total", "recommendation_text")


@register("market_edges", O.with_ctes(*gold_oracle_ctes(), _LATEST_CTE, _matchup_cte("own_side"),
                                      _forecast_sql("matchups"))
          + f" select {O.round_list(_EDGE_COLS[:-1], ints=_EDGE_COLS[:4])}, {_edges_sql()} as recommendation_text"
            " from forecast2")
def q_market_edges(spark, sf_dir):
    """T4 over the season-form forecast of every priced matchup."""
    feats = matchup_features(_requests(spark, sf_dir), latest(spark, sf_dir), "own_side")
    return rounded(market_edges(form_forecast(feats)).select(*_EDGE_COLS))


_EVAL = O.with_ctes(*gold_oracle_ctes(), f"""
gold_split as (select *, {_SPLIT_SQL} as split from gold)""", _forecast_sql("gold_split"))


def forecast_gold(spark, sf_dir) -> DataFrame:
    return form_forecast(split_gold(spark, sf_dir))


@register("eval_classifier", _EVAL + " select split, count(*) as n,"
          " cast(sum(cast(pred_home_win = home_win as integer)) as double) / count(*) as accuracy"
          " from forecast2 group by split")
def q_eval_classifier(spark, sf_dir):
    """Accuracy of the home-win call per split."""
    return accuracy(forecast_gold(spark, sf_dir), "home_win", "pred_home_win", by=("split",))


def _mae_sql(pred, label) -> str:
    return O.exact_avg(f"abs(cast({pred} as double) - cast({label} as double))")


@register("eval_regression", _EVAL + f" select split, count(*) as n,"
          f" {_mae_sql('pred_spread', 'final_home_margin')} + 0.0 as mae_spread,"
          f" {_mae_sql('pred_total', 'final_total_score')} + 0.0 as mae_total from forecast2 group by split")
def q_eval_regression(spark, sf_dir):
    """Spread and total MAE per split."""
    ev = evaluate(forecast_gold(spark, sf_dir))
    return rounded(ev.select("split", "n", "mae_spread", "mae_total"))


@register("evaluate_splits", _EVAL + f" select split, count(*) as n,"
          " cast(sum(cast(pred_home_win = home_win as integer)) as double) / count(*) as accuracy,"
          " cast(sum(home_win) as double) / count(*) as home_win_rate,"
          f" {_mae_sql('pred_spread', 'final_home_margin')} + 0.0 as mae_spread,"
          f" {_mae_sql('pred_total', 'final_total_score')} + 0.0 as mae_total from forecast2 group by split")
def q_evaluate_splits(spark, sf_dir):
    """M7: accuracy, base rate and both MAEs per split in one aggregate."""
    return rounded(evaluate(forecast_gold(spark, sf_dir)))


@register("confusion_matrix", _EVAL + " select split, home_win as actual,"
          " count(*) filter (where pred_home_win = 0) as predicted_away,"
          " count(*) filter (where pred_home_win = 1) as predicted_home"
          " from forecast2 group by split, home_win")
def q_confusion_matrix(spark, sf_dir):
    """Actual x predicted home-win counts per split."""
    return confusion_matrix(forecast_gold(spark, sf_dir), "home_win", "pred_home_win", by=("split",))


# --- repairs and parameters of the survey's quirks ---------------------------------------

from gridcast.operators.quality import margin_disagreements  # noqa: E402
from gridcast.sources.files import delete_path, read_odds_csv, read_plays_csv  # noqa: E402

# Last regular week by season of the season-aware stand-in weeks.
_STANDIN_LAST_REGULAR = {0: 49, 1997: 50, 1998: 52}


@register("odds_clean_season_weeks", O.with_ctes(O.STANDIN_CTES, O.odds_clean_cte(week_case="""
  case o.schedule_week
    when 'Wildcard' then (case when o.schedule_season >= 1998 then 53 when o.schedule_season >= 1997 then 51 else 50 end)
    when 'Division' then (case when o.schedule_season >= 1998 then 54 when o.schedule_season >= 1997 then 52 else 51 end)
    when 'Conference' then (case when o.schedule_season >= 1998 then 55 when o.schedule_season >= 1997 then 53 else 52 end)
    when 'Superbowl' then (case when o.schedule_season >= 1998 then 56 when o.schedule_season >= 1997 then 54 else 53 end)
    else try_cast(o.schedule_week as integer) end""")) + " select * from odds_clean")
def q_odds_clean_season_weeks(spark, sf_dir):
    """P7 (Q3 repaired): playoff rounds follow each season's last regular week."""
    return rounded(silver_odds(spark, sf_dir, schemas.LITERAL_WEEK_NAMES, _STANDIN_LAST_REGULAR))


def _form_after_sql() -> str:
    cols = O.TEAM_GAME_COLUMNS + ("off_epa_avg",) + tuple(schemas.team_form_columns())
    return (O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.team_games_cte(),
                        O.team_form_cte(frame_recent="rows between 3 preceding and current row",
                                        frame_season="rows between unbounded preceding and current row"))
            + f" select {O.round_list(cols, ints=O.TEAM_GAME_COLUMNS)} from team_form")


@register("rolling_after_latest", _form_after_sql())
def q_rolling_after_latest(spark, sf_dir):
    """W1-W4 with frames that end at the current game (Q5 repaired): the form a
    forecast of the next game starts from."""
    return rounded(team_form(team_games(spark, sf_dir), as_of="after_latest"))


@register("matchup_features_favorite_line", O.with_ctes(*gold_oracle_ctes(), _LATEST_CTE, _matchup_cte("own_side"))
          + " select season, week, home_team, away_team, (-abs(vegas_spread) + 0.0) as spread_favorite, is_favorite_home"
            " from matchups")
def q_matchup_features_favorite_line(spark, sf_dir):
    """T2 (Q7): the request's home line turned into the training data's convention,
    the favourite's line with a separate flag."""
    feats = matchup_features(_requests(spark, sf_dir), latest(spark, sf_dir),
                             spread_convention="favorite")
    return rounded(feats.select("season", "week", "home_team", "away_team", "spread_favorite", "is_favorite_home"))


@register("matchup_unknown_teams", O.with_ctes(*gold_oracle_ctes(), _LATEST_CTE)
          + " select n_name as home_team, 'N0' as away_team, exists (select 1 from latest l where l.team = n_name)"
            " and exists (select 1 from latest l where l.team = 'N0') as teams_known from nation"
            " union all select 'N' || n_nationkey, 'N0', exists (select 1 from latest l where l.team = 'N' || n_nationkey)"
            " and exists (select 1 from latest l where l.team = 'N0') from nation")
def q_matchup_unknown_teams(spark, sf_dir):
    """T2 (Q9 repaired): requests that name a team without games are flagged rows, not
    failures.  Every nation is asked for by its code and by its name, which no game has."""
    from gridcast.sources.files import read_table
    n = read_table(spark, sf_dir, "nation").select(F.explode(F.array(
        "n_name", F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))).alias("home_team"))
    asked = n.select("home_team", F.lit("N0").alias("away_team"), F.lit(None).cast("double").alias("vegas_spread"),
                     F.lit(None).cast("double").alias("vegas_total"))
    return matchup_features(asked, latest(spark, sf_dir)).select("home_team", "away_team", "teams_known")


@register("margin_disagreements", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte(), O.game_base_cte())
          + " select season, count(*) as n_games, count(*) filter (where final_home_score - final_away_score <> final_home_margin) as n_disagree,"
            " count(*) filter (where final_home_score is null or final_away_score is null or final_home_margin is null) as n_unknown"
            " from game_base group by season")
def q_margin_disagreements(spark, sf_dir):
    """Q15: games whose scores over the kept plays disagree with the recorded result."""
    return margin_disagreements(game_base(silver_plays(spark, sf_dir)))


@register("column_summary_odd_numbers", O.with_ctes(O.STANDIN_CTES, """
odd as (
  select case l_linenumber % 6 when 0 then 'NaN' when 1 then 'Infinity' when 2 then '-Infinity' when 3 then '1e30'
         when 4 then 'NA' else cast(cast(l_quantity as integer) as varchar) end as x from lineitem
)""") + """
select 'x' as column_name, count(x) as count,
  cast(sum(case when regexp_full_match(x, '[0-9]+') then cast(x as bigint) end) as double)
    / count(case when regexp_full_match(x, '[0-9]+') then 1 end) as mean,
  round(stddev_samp(case when regexp_full_match(x, '[0-9]+') then cast(x as double) end), 6) as stddev,
  min(x) as min, max(x) as max from odd""")
def q_column_summary_odd_numbers(spark, sf_dir):
    """NaN, infinities and numbers out of range are text without a value."""
    from gridcast.sources.files import read_table
    kind = F.col("l_linenumber") % 6
    x = (F.when(kind == 0, "NaN").when(kind == 1, "Infinity").when(kind == 2, "-Infinity").when(kind == 3, "1e30")
         .when(kind == 4, "NA").otherwise(F.col("l_quantity").cast("int").cast("string")))
    return rounded(column_summary(read_table(spark, sf_dir, "lineitem").select(x.alias("x")), ["x"]))


# --- CSV sources ----------------------------------------------------------------------

#: Seasons whose files a task has open at once, and rows a file.
SEASONS_OPEN, ROWS_A_FILE = 64, 500_000


def _write_csv_by_season(df: DataFrame, path: str, season: str) -> None:
    """The bronze table as headered CSV, compressed, one folder per season, the columns of odd
    seasons in reverse order.  The table is worked out once, for both orders; its shuffles go
    with its write, and it goes when the files are there.  A task has a file open for each
    season instead of sorting its rows (beyond ``SEASONS_OPEN`` it sorts the rest)."""
    spark, table = df.sparkSession, _own_folder(df.sparkSession, "bronze")
    odd = F.col(season).cast("int") % 2 == 1
    try:
        with held(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            df.write.option("compression", "zstd").parquet(table)
        bronze = spark.read.schema(df.schema).parquet(table)
        with held(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(SEASONS_OPEN)}):
            for part, names in ((~odd, df.columns), (odd, df.columns[::-1])):
                (bronze.where(part).select(*names).withColumn("_folder", F.col(season)).write.mode("append").partitionBy("_folder")
                 .option("header", "true").option("emptyValue", "").option("compression", "lz4").option("maxRecordsPerFile", ROWS_A_FILE).csv(path))
    finally:
        delete_path(spark, table)


def _without_folder(df: DataFrame) -> DataFrame:
    return df.drop("_folder")


@register("csv_plays_clean", O.with_ctes(O.STANDIN_CTES, O.plays_clean_cte())
          + f" select {O.PLAYS_CLEAN_COLUMNS} from plays_clean")
def q_csv_plays_clean(spark, sf_dir):
    """Bronze plays written as season CSVs with columns in differing order, read
    by each file's header, then cleaned like ``plays_clean``."""
    path = f"{_own_folder(spark, 'bronze_plays')}"
    _write_csv_by_season(standin.plays(spark, sf_dir), path, "season")
    bronze = _without_folder(read_plays_csv(spark, path, all_columns=True))
    silver = clean_plays(bronze, schemas.KEEP_TYPES, dedupe_order=DEDUPE_ORDER)
    return rounded(silver.select(*_SILVER_COLUMNS))


@register("csv_odds_clean", O.with_ctes(O.STANDIN_CTES, O.odds_clean_cte(schemas.LITERAL_WEEK_NAMES))
          + " select * from odds_clean")
def q_csv_odds_clean(spark, sf_dir):
    """Bronze odds through CSV files with columns in differing order."""
    path = f"{_own_folder(spark, 'bronze_odds')}"
    _write_csv_by_season(standin.odds(spark, sf_dir), path, "schedule_season")
    return rounded(clean_odds(read_odds_csv(spark, path), standin.team_map(spark, sf_dir), after=standin.STANDIN_AFTER,
                              week_names=schemas.LITERAL_WEEK_NAMES, last_regular=None))


def _own_folder(spark, name: str) -> str:
    import uuid

    from gridcast.session import scratch_path
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


# --- boosted-tree models ---------------------------------------------------------------

from gridcast.operators.models import (GameModel, feature_importances, fit_games, load_model,  # noqa: E402
                                       predict, residuals, save_model, top_importances)
from gridcast.operators.scoring import score_matchups  # noqa: E402
from gridcast.session import scratch_path  # noqa: E402
from gridcast.sources.files import path_exists, read_gold  # noqa: E402


def training_folder(spark, sf_dir: str) -> str:
    """The stand-in's training job: split gold and the model (the original's settings,
    500 rounds) as files under the application's own folder.  A model that is there is
    not fitted again, as a training job's result is used by many scoring jobs; what
    each query does beyond that is load and apply."""
    import hashlib
    root = scratch_path(spark, f"trained/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
    if not path_exists(spark, f"{root}/gold/_SUCCESS"):
        split_gold(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/gold")
    return root


def training_data(spark, sf_dir: str) -> DataFrame:
    return read_gold(spark, f"{training_folder(spark, sf_dir)}/gold")


def trained(spark, sf_dir: str) -> GameModel:
    """The model of all targets, read from where the training job wrote it."""
    path = f"{training_folder(spark, sf_dir)}/model"
    if not path_exists(spark, path):
        save_model(fit_games(training_data(spark, sf_dir), FEATURES), path, spark)
    return load_model(path, FEATURES, spark)


def _held_out():
    return F.col("split").isin("val", "test")


def _predicted(spark, sf_dir) -> DataFrame:
    return predict(trained(spark, sf_dir), training_data(spark, sf_dir))


@register("fit_home_win")
def q_fit_home_win(spark, sf_dir):
    """M2 M3 M6: boosted home-win classifier; predictions on validation and test."""
    return predict(trained(spark, sf_dir).only("win"), training_data(spark, sf_dir)).where(_held_out()).select(
        "game_id", "season", "split", "home_win", "pred_home_win", "prob_home_win")


@register("fit_margin")
def q_fit_margin(spark, sf_dir):
    """M5 M6: boosted home-margin regressor; predictions on validation and test."""
    return predict(trained(spark, sf_dir).only("spread"), training_data(spark, sf_dir)).where(_held_out()).select(
        "game_id", "season", "split", "final_home_margin", "pred_spread")


@register("fit_total")
def q_fit_total(spark, sf_dir):
    """M4 M6: boosted total-points regressor; predictions on validation and test."""
    return predict(trained(spark, sf_dir).only("total"), training_data(spark, sf_dir)).where(_held_out()).select(
        "game_id", "season", "split", "final_total_score", "pred_total")


@register("model_evaluation")
def q_model_evaluation(spark, sf_dir):
    """M7 on the boosted models: accuracy, base rate, spread and total MAE per split."""
    return evaluate(_predicted(spark, sf_dir))


@register("top_importances")
def q_top_importances(spark, sf_dir):
    """K3: the 15 most important features of the home-win model."""
    return top_importances(trained(spark, sf_dir), spark=spark)


def _residuals(spark, sf_dir) -> DataFrame:
    p = _predicted(spark, sf_dir)
    both = (("total", "final_total_score", "pred_total"), ("spread", "final_home_margin", "pred_spread"))
    parts = [residuals(p, label, pred, "test").withColumn("target", F.lit(t)) for t, label, pred in both]
    return parts[0].unionByName(parts[1])


@register("residuals")
def q_residuals(spark, sf_dir):
    """M8: actual vs predicted total points and home margin on the test split."""
    return _residuals(spark, sf_dir)


def _scored(spark, sf_dir) -> DataFrame:
    return score_matchups(_requests(spark, sf_dir), training_data(spark, sf_dir), trained(spark, sf_dir))


@register("score_matchups")
def q_score_matchups(spark, sf_dir):
    """M9 T5: saved models loaded, then every priced matchup scored with the latest
    form of both teams and labelled with edges."""
    return _scored(spark, sf_dir).select(*_MATCHUP_KEYS, "prob_home_win", "pred_spread", "pred_total",
                                         "recommendation_text")


# What SQL can say of the models: which rows have a prediction and what must hold of it.

_MODEL_GOLD = O.with_ctes(*gold_oracle_ctes(), f"""
gold_split as (select *, {_SPLIT_SQL} as split from gold)""")


@register("model_predictions_check", _MODEL_GOLD
          + " select game_id, split, cast(home_win as integer) as home_win, cast(final_home_margin as integer) as final_home_margin,"
            " cast(final_total_score as integer) as final_total_score, true as prob_in_range, true as class_follows,"
            " true as numbers_finite from gold_split")
def q_model_predictions_check(spark, sf_dir):
    """M2-M6: every game of every split has its labels and predictions: probability in
    [0, 1], class 1 exactly above one half, finite margin and total."""
    p = _predicted(spark, sf_dir)
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e6) for c in ("pred_spread", "pred_total")]
    return p.select("game_id", "split", "home_win", "final_home_margin", "final_total_score",
                    F.col("prob_home_win").between(0.0, 1.0).alias("prob_in_range"),
                    (F.col("pred_home_win").cast("int") == (F.col("prob_home_win") > 0.5).cast("int")).alias("class_follows"),
                    (finite[0] & finite[1]).alias("numbers_finite"))


@register("model_learning_check", _MODEL_GOLD
          + " select count(*) as n_train, true as beats_mean_spread, true as beats_mean_total, true as beats_base_rate"
            " from gold_split where split = 'train'")
def q_model_learning_check(spark, sf_dir):
    """M3-M5 M7: on the training games the models have a smaller error than the mean
    label, and are right more often than the base rate."""
    p = _predicted(spark, sf_dir).where("split = 'train'")

    def err(a, b):
        return F.avg(F.pow(F.col(a) - F.col(b), 2))

    hit = F.avg((F.col("pred_home_win").cast("int") == F.col("home_win")).cast("double"))
    base = F.greatest(F.avg(F.col("home_win").cast("double")), 1 - F.avg(F.col("home_win").cast("double")))
    return p.agg(F.count("*").alias("n_train"), (err("pred_spread", "final_home_margin") < F.var_pop("final_home_margin")).alias("beats_mean_spread"),
                 (err("pred_total", "final_total_score") < F.var_pop("final_total_score")).alias("beats_mean_total"), (hit > base).alias("beats_base_rate"))


@register("model_reload_check", _MODEL_GOLD + " select split, count(*) as n_games, count(*) as n_equal from gold_split group by split")
def q_model_reload_check(spark, sf_dir):
    """M9: a model saved anew and loaded predicts every game as the one it came from."""
    model, path = trained(spark, sf_dir), _own_folder(spark, "resaved")
    save_model(model, path, spark)
    names = ("prob_home_win", "pred_home_win", "pred_total", "pred_spread")
    first = predict(model, training_data(spark, sf_dir)).withColumnsRenamed({c: f"first_{c}" for c in names})
    again = predict(load_model(path, FEATURES, spark), first)
    equal = F.lit(True)
    for c in names:
        equal = equal & F.col(c).eqNullSafe(F.col(f"first_{c}"))
    return again.groupBy("split").agg(F.count("*").alias("n_games"), F.count_if(equal).alias("n_equal"))


@register("importances_check", "select unnest(['" + "', '".join(FEATURES) + "']) as feature, true as in_range, true as sums_to_one")
def q_importances_check(spark, sf_dir):
    """K3: an importance in [0, 1] for each of the 39 features, one in all."""
    rows = feature_importances(trained(spark, sf_dir))   # a row per feature
    whole = abs(sum(v for _, v in rows) - 1) < 1e-6
    return spark.createDataFrame([(f, 0 <= v <= 1, whole) for f, v in rows], "feature string, in_range boolean, sums_to_one boolean")


@register("residuals_check", _MODEL_GOLD
          + " select game_id, 'total' as target, cast(final_total_score as double) as actual, true as adds_up from gold_split where split = 'test'"
            " union all select game_id, 'spread', cast(final_home_margin as double), true from gold_split where split = 'test'")
def q_residuals_check(spark, sf_dir):
    """M8: actual values of both targets, and residual = predicted - actual."""
    r = _residuals(spark, sf_dir)
    return r.select("game_id", "target", "actual", (F.abs(F.col("residual") - (F.col("predicted") - F.col("actual"))) < 1e-9).alias("adds_up"))


@register("score_matchups_check", O.with_ctes(*gold_oracle_ctes())
          + " select season, week, home_team, away_team, spread_favorite as vegas_spread, over_under_line as vegas_total,"
            " true as edges_follow from odds_clean")
def q_score_matchups_check(spark, sf_dir):
    """T5: every priced matchup is scored, and its edges follow from its predictions."""
    s = _scored(spark, sf_dir)
    text = F.col("recommendation_text")
    win = F.when(F.col("prob_home_win") > 0.6, text.contains("BET HOME")).when(F.col("prob_home_win") < 0.4, text.contains("BET AWAY")).otherwise(
        ~text.contains("BET HOME") & ~text.contains("BET AWAY"))
    gap = F.col("pred_total") - F.col("vegas_total")
    total = F.when(gap > 2.0, text.contains("BET OVER")).when(gap < -2.0, text.contains("BET UNDER")).otherwise(
        ~text.contains("BET OVER") & ~text.contains("BET UNDER"))
    lead = F.col("pred_spread") - F.col("vegas_spread")
    spread = F.when(lead < -1.5, text.contains("OPPOSITE SPREAD")).otherwise(~text.contains("OPPOSITE SPREAD"))
    return rounded(s.select(*_MATCHUP_KEYS, (win & total & spread).alias("edges_follow")))
