"""DuckDB oracle texts for the registered queries.

Each text inlines the stand-in views (X1-X4) and the silver/gold stages as CTEs
over the driver's base tables.  The clauses are written out here; names of metrics,
play types and labels come from ``schemas``, which both sides share, so a wrong name
there is not seen.  Averages are exact sums divided once, so doubles
agree bit for bit without rounding.
"""

from __future__ import annotations

from gridcast import schemas
from gridcast.sources.standin import (STANDIN_AFTER, STANDIN_PLAY_TYPES, STANDIN_UNMAPPED_NATION,
                                      STANDIN_WEEK_NAMES, STANDIN_WEEK_NUMBERS)

def _dbl(x: str) -> str:
    d = f"try_cast({x} as double)"
    return f"(case when abs({d}) < 1e20 and not isnan({d}) then {d} end)"


def _int(x: str) -> str:
    return f"try_cast(trunc({_dbl(x)}) as integer)"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def r(expr: str, alias: str) -> str:
    # doubles are computed exactly on both engines (exact sums, one division), so
    # no rounding is needed; "+ 0.0" only turns -0.0 into 0.0
    return f"({expr} + 0.0) as {alias}"


def int_avg(x: str, over: str = "") -> str:
    """Average of an integral column: exact integer sum / count, one division."""
    return f"(cast(sum({x}){over} as double) / nullif(count({x}){over}, 0))"


def exact_avg(x: str, over: str = "") -> str:
    """Exact average: decimal sum, parsed to double through its text (a correctly
    rounded conversion), divided by the non-null count."""
    # double -> decimal through its shortest text, as Spark converts it
    s = f"sum(cast(cast({x} as varchar) as decimal(38,18))){over}"
    return f"(cast(cast({s} as varchar) as double) / nullif(count({x}){over}, 0))"


_PTYPE_CASE = "case l.l_partkey % 7 " + " ".join(
    f"when {i} then '{t}'" for i, t in enumerate(STANDIN_PLAY_TYPES[:-1])) + f" else '{STANDIN_PLAY_TYPES[-1]}' end"

_WEEK_NAME_CASE = "case q.week " + " ".join(
    f"when {k} then '{v}'" for k, v in STANDIN_WEEK_NAMES.items()) + " else cast(q.week as varchar) end"

STANDIN_CTES = f"""
fx_games as (
  select o.o_orderkey as game_id, cast(o.o_orderdate as date) as game_date,
    cast(year(o.o_orderdate) as int) as season,
    cast(floor((dayofyear(o.o_orderdate) - 1) / 7) as int) + 1 as week,
    c.c_nationkey as hk, cast((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 as int) as ak,
    case when o.o_orderkey % 50 = 0 then null when o.o_orderstatus = 'P' then 'POST' else 'REG' end as season_type
  from orders o join customer c on o.o_custkey = c.c_custkey
),
fx_pbp as (
  select cast(l.l_linenumber as varchar) as play_id, cast(g.game_id as varchar) as game_id,
    cast(g.game_date as varchar) as game_date, cast(g.season as varchar) as season,
    cast(g.week as varchar) as week, g.season_type as season_type,
    concat('N', cast(g.hk as varchar)) as home_team, concat('N', cast(g.ak as varchar)) as away_team,
    case when l.l_tax = 0 then null when l.l_suppkey % 2 = 0 then concat('N', cast(g.hk as varchar)) else concat('N', cast(g.ak as varchar)) end as posteam,
    case when l.l_tax = 0 then null when l.l_suppkey % 2 = 0 then concat('N', cast(g.ak as varchar)) else concat('N', cast(g.hk as varchar)) end as defteam,
    {_PTYPE_CASE} as play_type,
    case when l.l_partkey % 7 = 0 then cast(l.l_linenumber as varchar) else 'NA' end as air_yards,
    case when l.l_partkey % 7 = 0 then cast(cast(floor(l.l_quantity) as int) as varchar) else '' end as yards_after_catch,
    cast(cast(floor(l.l_quantity) as int) - 10 as varchar) as yards_gained,
    cast(cast(l.l_discount as decimal(12,2)) - cast(0.05 as decimal(12,2)) as varchar) as epa,
    cast(cast(floor(l.l_quantity) as int) as varchar) as total_home_score,
    cast(cast(floor(l.l_extendedprice) as int) % 50 as varchar) as total_away_score,
    case when g.game_id % 40 = 0 then 'NA' when hn.n_regionkey = an.n_regionkey then '1' else '0' end as div_game,
    cast(max(cast(floor(l.l_quantity) as int)) over (partition by g.game_id)
       - max(cast(floor(l.l_extendedprice) as int) % 50) over (partition by g.game_id) as varchar) as result,
    concat(cast(l.l_partkey as varchar), '-', cast(l.l_suppkey as varchar), '-',
      cast(cast(l.l_extendedprice as decimal(14,2)) as varchar), '-', cast(cast(l.l_quantity as decimal(14,2)) as varchar), '-',
      cast(cast(l.l_discount as decimal(14,2)) as varchar), '-', cast(cast(l.l_tax as decimal(14,2)) as varchar)) as src_seq
  from lineitem l join fx_games g on l.l_orderkey = g.game_id
  join nation hn on g.hk = hn.n_nationkey join nation an on g.ak = an.n_nationkey
),
fx_team_map as (
  select n_name as team_name, concat('N', cast(n_nationkey as varchar)) as team_code
  from nation where n_nationkey <> {STANDIN_UNMAPPED_NATION}
),
fx_odds as (
  select q.season as schedule_season, {_WEEK_NAME_CASE} as schedule_week,
    hn.n_name as team_home, an.n_name as team_away,
    case when q.game_id % 11 = 0 then null when q.game_id % 2 = 0 then concat('N', cast(q.hk as varchar)) else concat('N', cast(q.ak as varchar)) end as team_favorite_id,
    cast(-(q.game_id % 41) as double) / 2.0 as spread_favorite,
    case when q.game_id % 17 = 0 then ' ' else cast(30 + q.game_id % 36 as varchar) end as over_under_line
  from (select g.*, row_number() over (partition by season, week, hk, ak order by game_id) as rn
        from fx_games g) q
  join nation hn on q.hk = hn.n_nationkey join nation an on q.ak = an.n_nationkey
  where q.rn = 1
)"""


def plays_clean_cte(keep_types=schemas.KEEP_TYPES) -> str:
    return f"""
plays_typed as (
  select play_id, game_id, try_cast(game_date as date) as game_date,
    {_int('season')} as season, {_int('week')} as week,
    case when season_type = 'REG' then 0 else 1 end as is_playoffs,
    home_team, away_team, posteam, defteam, play_type,
    {_int('air_yards')} as air_yards, {_int('yards_after_catch')} as yards_after_catch,
    {_int('yards_gained')} as yards_gained, {_dbl('epa')} as epa,
    {_int('total_home_score')} as total_home_score, {_int('total_away_score')} as total_away_score,
    {_int('div_game')} as div_game, {_int('result')} as home_margin, src_seq
  from fx_pbp where play_type in {_in(keep_types)}
),
plays_clean as (
  select * exclude (rn) from (
    select *, row_number() over (partition by game_id, play_id order by src_seq) as rn from plays_typed)
  where rn = 1
)"""


PLAYS_CLEAN_COLUMNS = ("play_id, game_id, game_date, season, week, is_playoffs, home_team, away_team, "
                       "posteam, defteam, play_type, air_yards, yards_after_catch, yards_gained, epa, "
                       "total_home_score, total_away_score, div_game, home_margin, src_seq")


def odds_clean_cte(week_names=STANDIN_WEEK_NUMBERS, after=STANDIN_AFTER, week_case: str | None = None) -> str:
    week_case = week_case or "case o.schedule_week " + " ".join(
        f"when '{k}' then {v}" for k, v in week_names.items()) + f" else {_int('o.schedule_week')} end"
    home = "coalesce(hm.team_code, o.team_home)"
    return f"""
odds_clean as (
  select cast(o.schedule_season as int) as season, {week_case} as week,
    {home} as home_team, coalesce(am.team_code, o.team_away) as away_team,
    case when o.team_favorite_id = {home} then 1 else 0 end as is_favorite_home,
    cast(o.spread_favorite as double) as spread_favorite,
    {_dbl('o.over_under_line')} as over_under_line
  from fx_odds o
  left join fx_team_map hm on o.team_home = hm.team_name
  left join fx_team_map am on o.team_away = am.team_name
  where o.schedule_season > {after}
)"""


def game_base_cte(pass_types=schemas.PASS_TYPES, rush_types=schemas.RUSH_TYPES) -> str:
    off = _in(tuple(pass_types) + tuple(rush_types))
    return f"""
game_base as (
  select game_id, season, game_date, week, home_team, away_team, div_game, is_playoffs,
    max(total_home_score) as final_home_score, max(total_away_score) as final_away_score,
    max(total_home_score) + max(total_away_score) as final_total_score,
    max(home_margin) as final_home_margin,
    case when max(total_home_score) > max(total_away_score) then 1 else 0 end as home_win,
    cast(sum(case when play_type in {_in(pass_types)} then 1 else 0 end) as bigint) as total_pass_plays,
    cast(sum(case when play_type in {_in(rush_types)} then 1 else 0 end) as bigint) as total_rush_plays,
    cast(sum(case when play_type in {off} then yards_gained else 0 end) as bigint) as total_offensive_yards,
    {exact_avg('epa')} as avg_epa_per_play
  from plays_clean
  group by game_id, season, game_date, week, home_team, away_team, div_game, is_playoffs
)"""


GAME_BASE_INT = ("game_id", "season", "game_date", "week", "home_team", "away_team", "div_game",
                 "is_playoffs", "final_home_score", "final_away_score", "final_total_score",
                 "final_home_margin", "home_win", "total_pass_plays", "total_rush_plays",
                 "total_offensive_yards")


def team_games_cte(pass_types=schemas.PASS_TYPES, rush_types=schemas.RUSH_TYPES) -> str:
    return f"""
team_games as (
  select game_id, season, week, posteam, defteam, home_team, away_team,
    {exact_avg('epa')} as off_epa_avg,
    cast(sum(case when play_type in {_in(pass_types)} then yards_gained else 0 end) as bigint) as pass_yds,
    cast(sum(case when play_type in {_in(rush_types)} then yards_gained else 0 end) as bigint) as rush_yds,
    cast(sum(yards_gained) as bigint) as total_yds,
    count(play_id) as team_plays,
    max(case when posteam = home_team then total_home_score
             when posteam = away_team then total_away_score else 0 end) as off_final_points_scored
  from plays_clean where posteam is not null
  group by game_id, season, week, posteam, defteam, home_team, away_team
)"""


TEAM_GAME_COLUMNS = ("game_id", "season", "week", "posteam", "defteam", "home_team", "away_team",
                     "pass_yds", "rush_yds", "total_yds", "team_plays", "off_final_points_scored")


def _metric_expr(m: schemas.RollingMetric) -> str:
    return f"(-1 * {m.source})" if m.negate else m.source


def team_form_cte(metrics=schemas.ALL_METRICS, source="team_games",
                  frame_recent="rows between 4 preceding and 1 preceding",
                  frame_season="rows between unbounded preceding and 1 preceding") -> str:
    cols = []
    for m in metrics:
        w = "off" if m.entity == "posteam" else "def"
        x = _metric_expr(m)
        if m.source == "off_epa_avg":
            cols.append(f"{exact_avg(x, f' over w_{w}_recent')} as {m.name}_recent_avg")
            cols.append(f"{exact_avg(x, f' over w_{w}_season')} as {m.name}_season_avg")
        else:
            cols.append(f"{int_avg(x, f' over w_{w}_recent')} as {m.name}_recent_avg")
            cols.append(f"{int_avg(x, f' over w_{w}_season')} as {m.name}_season_avg")
    frame_r, frame_s = frame_recent, frame_season
    return f"""
team_form as (
  select *, {', '.join(cols)}
  from {source}
  window w_off_recent as (partition by posteam, season order by week, game_id {frame_r}),
         w_off_season as (partition by posteam, season order by week, game_id {frame_s}),
         w_def_recent as (partition by defteam, season order by week, game_id {frame_r}),
         w_def_season as (partition by defteam, season order by week, game_id {frame_s})
)"""


def side_pivot_cte(defense_side="own", metrics=schemas.ALL_METRICS) -> str:
    cols = []
    for side in ("home", "away"):
        for m in metrics:
            if m.entity == "defteam" and defense_side == "own":
                cond = f"defteam = {side}_team"
            else:
                cond = f"posteam = {side}_team"
            for team_suffix, gold_suffix in schemas.FRAMES.values():
                cols.append(f"max(case when {cond} then {m.name}_{team_suffix} end) as {side}_{m.name}_{gold_suffix}")
    return f"""
side_pivot as (
  select game_id, {', '.join(cols)} from team_form group by game_id
)"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join(c.strip("\n") for c in ctes)


def round_list(cols, ints=()) -> str:
    return ", ".join(c if c in ints else r(c, c) for c in cols)
