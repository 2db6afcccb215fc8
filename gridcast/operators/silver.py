"""Bronze -> silver operators: casts, filters, renames, value maps, de-duplication
(P2-P11, D1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.functions.columns import (favourite_is_home, normalise_week, parse_date,
                                        playoff_flag, to_double, to_int)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tolerant casts of text columns: ``{"season": "int", "epa": "double"}``."""
    conv = {"int": to_int, "double": to_double}
    return df.withColumns({c: conv[t](c) for c, t in types.items() if c in df.columns})


def filter_play_types(df: DataFrame, types: Sequence[str] = schemas.KEEP_TYPES) -> DataFrame:
    """Keep only the listed play types (P3); pushed to the scan by Catalyst."""
    return df.where(F.col("play_type").isin(list(types)))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def filter_min_season(df: DataFrame, after: int = 2019, col: str = "schedule_season") -> DataFrame:
    """Keep rows with season strictly after ``after``."""
    return df.where(F.col(col) > after)


def filter_has_possession(df: DataFrame) -> DataFrame:
    """Plays with an offence (P10)."""
    return df.where(F.col("posteam").isNotNull())


def map_values(df: DataFrame, cols: Sequence[str], mapping, key: str = "team_name",
               value: str = "team_code") -> DataFrame:
    """Whole-cell replacement in ``cols``; unmapped values pass through.

    ``mapping`` is either a dict (becomes a literal map expression, no join) or a
    DataFrame with ``key``/``value`` columns (left join per column; the map is a
    dimension table, so Spark broadcasts it when its measured size is small).
    """
    if isinstance(mapping, Mapping):
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        return df.withColumns({c: F.coalesce(F.element_at(m, F.col(c)), F.col(c)) for c in cols})
    lookup = mapping.select(F.col(key).alias("_mk"), F.col(value).alias("_mv")).dropDuplicates(["_mk"])
    out = df
    for c in cols:
        out = (out.join(lookup, out[c] == lookup["_mk"], "left")
               .withColumn(c, F.coalesce(F.col("_mv"), F.col(c))).drop("_mk", "_mv"))
    return out


def dedupe(df: DataFrame, keys: Sequence[str] = ("game_id", "play_id"),
           order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key.

    The survivor is the least row by ``order_by`` and then by all other columns: a
    total order, so whatever the layout of the input the same row stays.  An
    ``order_by`` without a column beyond the keys orders nothing and is refused.

    It is a ``min`` aggregate: copies are collapsed map-side (partial aggregation)
    before the shuffle, so one key holding a large share of all rows never lands
    whole in one task.  Rows of text cannot be kept in a hash aggregate's buffer, so
    it sorts each task's rows by key; the rows are moved once.
    """
    keys = list(keys)
    first = [c for c in (order_by or ()) if c not in keys]
    if order_by and not first:
        raise ValueError(f"order_by {list(order_by)} has only key columns and leaves ties")
    others = first + [c for c in df.columns if c not in keys and c not in first]
    if not others:
        return df.dropDuplicates(keys)
    best = F.min(F.struct(*[F.col(c) for c in others])).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def clean_plays(bronze: DataFrame, keep_types: Sequence[str] = schemas.KEEP_TYPES,
                dedupe_order: Sequence[str] | None = None) -> DataFrame:
    """Bronze plays -> silver plays.

    Parses the date, casts ten numeric columns tolerantly, keeps ``keep_types``,
    turns ``season_type`` into ``is_playoffs`` and ``result`` into
    ``home_margin``, and keeps one row per ``(game_id, play_id)``.  Columns not
    named here pass through as text.
    """
    casts = {c: "int" for c in schemas.PLAY_INT_COLUMNS}
    casts.update({c: "double" for c in schemas.PLAY_DOUBLE_COLUMNS})
    df = filter_play_types(bronze, keep_types)
    df = df.withColumn("game_date", parse_date("game_date"))
    df = cast_columns(df, casts)
    df = rename_columns(df, {"season_type": "is_playoffs", "result": "home_margin"})
    df = df.withColumns({"is_playoffs": playoff_flag("is_playoffs"),
                         "home_margin": to_int("home_margin")})
    return dedupe(df, ("game_id", "play_id"), dedupe_order)


def clean_odds(bronze: DataFrame, team_map=None, after: int = 2019,
               week_names: Mapping[str, int] = schemas.LITERAL_WEEK_NAMES,
               last_regular: Mapping[int, int] | None = schemas.LAST_REGULAR_WEEK) -> DataFrame:
    """Bronze odds -> silver odds, 7 columns.

    Playoff rounds follow each season's last regular week (``last_regular``); None
    gives the original's numbers, the same for all seasons (quirk Q3).  ``team_map`` defaults to the fixed 33-entry name -> code map; a DataFrame
    with ``team_name``/``team_code`` may be given instead.
    """
    df = filter_min_season(bronze, after)
    df = map_values(df, ["team_home", "team_away"],
                    schemas.TEAM_NAME_TO_CODE if team_map is None else team_map)
    df = rename_columns(df, {"schedule_season": "season", "schedule_week": "week",
                             "team_home": "home_team", "team_away": "away_team"})
    return df.select(
        F.col("season").cast("int").alias("season"),
        normalise_week("week", week_names, "season" if last_regular else None, last_regular).alias("week"),
        "home_team", "away_team",
        favourite_is_home("team_favorite_id", "home_team").alias("is_favorite_home"),
        F.col("spread_favorite").cast("double").alias("spread_favorite"),
        to_double(F.col("over_under_line").cast("string")).alias("over_under_line"),
    )
