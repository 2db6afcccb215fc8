"""Stand-in bronze inputs derived from the driver's star-schema tables.

A deterministic "sports" reading of the tables: an order is a game, a line is
a play, a nation is a team, the order year is the season.  The same views are
written as DuckDB SQL in ``gridcast.plans.oracle`` so every operator can be
checked against an independent engine.  Everything here is a Spark plan over
the whole tables: joins on keys, pre-aggregated per-game maxima, no windows
over hot groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.columns import team_code
from gridcast.sources.files import read_table

# Fixed values of the stand-in: play types by ``l_partkey % 7`` and the names the
# odds file gives to stand-in weeks 50-53.
STANDIN_PLAY_TYPES = ("pass", "run", "punt", "field_goal", "extra_point", "kickoff", "no_play")
STANDIN_WEEK_NAMES = {50: "Wildcard", 51: "Division", 52: "Conference", 53: "Superbowl"}
# Season cut for the stand-in (order years are 1992-1998).
STANDIN_AFTER = 1995
# Playoff names mapped onto their own stand-in weeks (no collision with weeks 18-21).
STANDIN_WEEK_NUMBERS = {v: k for k, v in STANDIN_WEEK_NAMES.items()}
# Nation left out of the team map on purpose (its name passes through unmapped).
STANDIN_UNMAPPED_NATION = 24


def _text(c) -> F.Column:
    return c.cast("string")


def _dec_text(c, scale_def: str) -> F.Column:
    return c.cast(scale_def).cast("string")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: game id/date/season/week, home (hk) and away (ak)
    nation keys, season type."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    d = F.to_date("o_orderdate")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("game_id"),
        d.alias("game_date"),
        F.year(d).cast("int").alias("season"),
        (F.floor((F.dayofyear(d) - 1) / 7).cast("int") + 1).alias("week"),
        F.col("c_nationkey").alias("hk"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int").alias("ak"),
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "P", "POST").otherwise("REG").alias("season_type"),
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze play-by-play shape (every column text), one row per line item."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax").withColumn("_game", _text(F.col("l_orderkey")))
    qty = F.floor("l_quantity").cast("int")
    away_pts = F.floor("l_extendedprice").cast("int") % 50
    # the game result is per-game: lines are summed up by order in each task before the
    # shuffle (a second, two-column scan), then joined (no window over a possibly hot game)
    result = li.groupBy("_game").agg((F.max(qty) - F.max(away_pts)).alias("result"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    hn = nation.select(F.col("n_nationkey").alias("hk"), F.col("n_regionkey").alias("h_region"))
    an = nation.select(F.col("n_nationkey").alias("ak"), F.col("n_regionkey").alias("a_region"))
    g = (games(spark, sf_dir).join(hn, "hk").join(an, "ak")
         .withColumn("_game", _text(F.col("game_id"))).join(result, "_game"))
    # lines meet their games by a shuffle on the game at any size: a broadcast of a small
    # games table would leave all work on a line to the tasks that scan it.  The key is the
    # text that the plays have, so what is grouped by game later is in its place already
    x = li.join(g.hint("merge"), "_game")

    home = team_code("N", "hk")
    away = team_code("N", "ak")
    no_team = F.col("l_tax") == 0
    home_has_ball = F.col("l_suppkey") % 2 == 0
    ptype_idx = F.col("l_partkey") % 7
    ptype = F.element_at(F.array(*[F.lit(t) for t in STANDIN_PLAY_TYPES]), (ptype_idx + 1).cast("int"))
    is_pass = ptype_idx == 0
    money = "decimal(14,2)"
    return x.select(
        _text(F.col("l_linenumber")).alias("play_id"),
        F.col("_game").alias("game_id"),
        _text(F.col("game_date")).alias("game_date"),
        _text(F.col("season")).alias("season"),
        _text(F.col("week")).alias("week"),
        F.col("season_type"),
        home.alias("home_team"),
        away.alias("away_team"),
        F.when(no_team, F.lit(None).cast("string")).when(home_has_ball, home).otherwise(away).alias("posteam"),
        F.when(no_team, F.lit(None).cast("string")).when(home_has_ball, away).otherwise(home).alias("defteam"),
        ptype.alias("play_type"),
        F.when(is_pass, _text(F.col("l_linenumber"))).otherwise(F.lit("NA")).alias("air_yards"),
        F.when(is_pass, _text(qty)).otherwise(F.lit("")).alias("yards_after_catch"),
        _text(qty - 10).alias("yards_gained"),
        _text(F.col("l_discount").cast("decimal(12,2)") - F.lit("0.05").cast("decimal(12,2)")).alias("epa"),
        _text(qty).alias("total_home_score"),
        _text(away_pts).alias("total_away_score"),
        F.when(F.col("game_id") % 40 == 0, F.lit("NA"))
         .when(F.col("h_region") == F.col("a_region"), F.lit("1")).otherwise(F.lit("0")).alias("div_game"),
        _text(F.col("result")).alias("result"),
        F.concat_ws("-", _text(F.col("l_partkey")), _text(F.col("l_suppkey")),
                    _dec_text(F.col("l_extendedprice"), money), _dec_text(F.col("l_quantity"), money),
                    _dec_text(F.col("l_discount"), money), _dec_text(F.col("l_tax"), money)).alias("src_seq"),
    )


def team_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds-file team names -> team codes (one nation deliberately unmapped)."""
    n = read_table(spark, sf_dir, "nation")
    return n.where(F.col("n_nationkey") != STANDIN_UNMAPPED_NATION).select(
        F.col("n_name").alias("team_name"), team_code("N", "n_nationkey").alias("team_code"))


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze odds shape, one row per (season, week, home, away): the lowest game
    id of each such group.  Games of early seasons lose theirs in the season cut (P9).

    The group minimum is a partial+final aggregate, so a hot group is collapsed
    map-side instead of being ranked in one task.
    """
    g = games(spark, sf_dir)
    q = g.groupBy("season", "week", "hk", "ak").agg(F.min("game_id").alias("game_id"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hn = n.select(F.col("n_nationkey").alias("hk"), F.col("n_name").alias("team_home"))
    an = n.select(F.col("n_nationkey").alias("ak"), F.col("n_name").alias("team_away"))
    q = q.join(hn, "hk").join(an, "ak")
    week_name = None
    for num, name in STANDIN_WEEK_NAMES.items():
        cond = F.col("week") == num
        week_name = F.when(cond, F.lit(name)) if week_name is None else week_name.when(cond, F.lit(name))
    gid = F.col("game_id")
    return q.select(
        F.col("season").alias("schedule_season"),
        week_name.otherwise(_text(F.col("week"))).alias("schedule_week"),
        "team_home", "team_away",
        F.when(gid % 11 == 0, F.lit(None).cast("string"))
         .when(gid % 2 == 0, team_code("N", "hk")).otherwise(team_code("N", "ak")).alias("team_favorite_id"),
        ((-(gid % 41)).cast("double") / 2.0).alias("spread_favorite"),
        F.when(gid % 17 == 0, F.lit(" ")).otherwise(_text(30 + gid % 36)).alias("over_under_line"),
    )

# Chronological split of the stand-in seasons (order years 1992-1998).
STANDIN_TRAIN_TO = 1996
STANDIN_VAL = 1997
