"""Leak-free trailing averages of team form.

Every metric gets two ROWS frames that end one row before the current game, so
a feature only sees earlier games: the last ``recent`` games and the season to
date.  Frames restart each season; the first game of a season has no history
and gets null.  ``as_of="after_latest"`` moves both frames' ends to the current
game, for a forecast of the next one (quirk Q5).

``scan`` (the default) is a prefix scan over deterministic chunks: the rows of one
entity, season and week.  A window inside each chunk gives the sums over the
chunk's earlier rows; the last row of each chunk holds its totals and the values of
its last ``recent`` rows, and a window over these rows (at most one per week of an
(entity, season)) what lies before each chunk.  A row's frames are its chunk's part
plus the part before.  So a hot team-season spreads over as many tasks as it has
weeks, nothing is measured or written while the plan is built, and the row count
never changes the plan.  Rows and chunks of the first entity read one shuffle of the rows; for
a further entity the input is read again, in the keys and values alone, for its chunks: give
it a written table, as the gold build and the registered queries do.

``window`` is the plain ``avg(x) over (partition by entity, season order by week,
game_id rows ...)``: one task per (entity, season), for small groups.

Sums are exact (long for integral metrics, decimal(38,18) for fractional ones), so
both give the same doubles whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import schemas
from gridcast.functions.columns import EXACT, decimal_to_double, negate_metric

DEFAULT_ORDER = ("week", "game_id")
AS_OF = ("before_game", "after_latest")


def _names(m: schemas.RollingMetric) -> tuple[str, str]:
    return f"{m.name}_{schemas.FRAMES['recent'][0]}", f"{m.name}_{schemas.FRAMES['season'][0]}"


def by_entity(metrics) -> dict[str, list[schemas.RollingMetric]]:
    """The metrics of each entity, in order."""
    out: dict[str, list] = {}
    for m in metrics:
        out.setdefault(m.entity, []).append(m)
    return out


def _exact_type(dt: T.DataType) -> str:
    return "bigint" if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else EXACT


def _value(df: DataFrame, m: schemas.RollingMetric) -> tuple[F.Column, bool]:
    """The metric as an exactly summable column, and whether it is integral."""
    kind = _exact_type(df.schema[m.source].dataType)
    c = F.col(m.source)
    return (negate_metric(c) if m.negate else c).try_cast(kind), kind == "bigint"


def _add(a, b, integral: bool) -> F.Column:
    """Exact a + b.  decimal(38,18) + decimal(38,18) would be typed with 39 digits
    and lose a decimal place, so decimal operands are narrowed to 37 digits first
    (19 integral digits remain) and the sum keeps scale 18."""
    if integral:
        return a + b
    return (a.cast("decimal(37,18)") + b.cast("decimal(37,18)")).cast(EXACT)


def _ratio(total, count, integral: bool) -> F.Column:
    """Exact total divided once."""
    t = total.cast("double") if integral else decimal_to_double(total)
    return F.when(count > 0, t / count.cast("double"))


def _ends(as_of: str) -> int:
    if as_of not in AS_OF:
        raise ValueError(f"as_of must be one of {AS_OF}")
    return -1 if as_of == "before_game" else 0


def _window_pass(df: DataFrame, entity: str, metrics, recent: int, order, season: str, end: int, columns: Sequence[str]) -> DataFrame:
    base = Window.partitionBy(entity, season).orderBy(*order)
    w_recent = base.rowsBetween(end + 1 - recent, end)
    w_season = base.rowsBetween(Window.unboundedPreceding, end)
    cols = {}
    for m in metrics:
        r, s = _names(m)
        v, integral = _value(df, m)
        cols[r] = _ratio(F.sum(v).over(w_recent), F.count(v).over(w_recent), integral)
        cols[s] = _ratio(F.sum(v).over(w_season), F.count(v).over(w_season), integral)
    return df.withColumns(cols).select(*columns, *cols)


def _scan_pass(df: DataFrame, entity: str, metrics, recent: int, order, season: str, end: int, columns: Sequence[str],
               source: DataFrame | None = None) -> DataFrame:
    """``source``: the same rows before other entities' columns came to them, which are
    not worked out again for the chunks (None: there are no others)."""
    n, values = recent, {}
    for i, m in enumerate(metrics):
        values[f"_v{i}"] = _value(df, m)
    zero = {v: F.lit(0).cast("bigint" if integral else EXACT) for v, (_, integral) in values.items()}
    # the chunk as one key that is never null, for the window and for the join alike
    def keyed(rows: DataFrame) -> DataFrame:
        chunk = F.struct(F.col(entity).alias("e"), F.col(season).alias("s"), F.col(order[0]).alias("w"))
        return rows.withColumn("_chunk", chunk).withColumns({v: c for v, (c, _) in values.items()})
    # what the chunk or a whole-number value says is not moved a second time
    told = {entity: F.col("_chunk.e"), season: F.col("_chunk.s"), order[0]: F.col("_chunk.w")}
    for m, (v, (_, integral)) in zip(metrics, values.items(), strict=True):
        if integral and not m.negate:
            told.setdefault(m.source, F.col(v).cast(df.schema[m.source].dataType))
    told = {c: value for c, value in told.items() if c not in order[1:]}   # the window orders by these
    kept = [told[c].alias(c) if c in told else F.col(c) for c in columns]
    base = keyed(df).select("_chunk", *dict.fromkeys([*order[1:], *[c for c in columns if c not in told]]), *values)
    # the chunks ask for all columns of the rows, and no window for more than columns, so that both read one shuffle
    narrow, asked = (base, base.columns) if source is None else (keyed(source), ["_chunk"])

    # 1. inside each chunk: sums over its earlier rows
    inside = Window.partitionBy("_chunk").orderBy(*order[1:] or ["_chunk.w"])   # a chunk has one week
    earlier = inside.rowsBetween(Window.unboundedPreceding, end)
    last = inside.rowsBetween(end + 1 - n, end)
    rows = base.withColumn("_rn", F.row_number().over(inside))
    rows = rows.withColumns({f"{v}{k}": agg(v).over(w) for v in values
                             for k, agg, w in (("_es", F.sum, earlier), ("_ec", F.count, earlier),
                                               ("_ls", F.sum, last), ("_lc", F.count, last))})

    # 2. one row per chunk, its last: totals and the values of the last n rows
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    ends = narrow.select(
        "_chunk", F.row_number().over(inside).alias("_rn"),
        reduce(and_, [F.lead(c).over(inside).isNull() for c in asked]).alias("_end"),   # the chunk itself is never null
        *[F.lag(v, k).over(inside).alias(f"{v}_{k}") for v in values for k in range(n)],
        *[F.sum(v).over(so_far).alias(f"{v}_s") for v in values], *[F.count(v).over(so_far).alias(f"{v}_c") for v in values]).where("_end")
    last_rows = F.array(*[F.struct(*[F.col(f"{v}_{k}").alias(v) for v in values]) for k in range(n - 1, -1, -1)])
    chunks = ends.select("_chunk", F.slice(last_rows, -F.least("_rn", F.lit(n)), n).alias("_tail"), *[f"{v}_{k}" for v in values for k in "sc"])

    # 3. what lies before each chunk: sums, and sums of the last 0 .. n rows
    over = Window.partitionBy("_chunk.e", "_chunk.s").orderBy("_chunk.w")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    empty = F.array().cast(chunks.schema["_tail"].dataType)
    # every chunk has a row, so the last n rows are in the last n chunks
    carry = F.concat(*[F.coalesce(F.lag("_tail", k).over(over), empty) for k in range(n, 0, -1)])
    prior = chunks.select(F.col("_chunk").alias("_key"), carry.alias("_carry"),
                          *[F.sum(f"{v}_s").over(before).alias(f"{v}_ps") for v in values],
                          *[F.sum(f"{v}_c").over(before).alias(f"{v}_pc") for v in values])
    steps = {}
    for v, (_, integral) in values.items():
        total, count = zero[v], F.lit(0).cast("bigint")
        totals, counts = [total], [count]
        for k in range(1, n + 1):
            x = F.try_element_at(F.col("_carry"), F.lit(-k))[v]
            total = _add(total, F.coalesce(x, zero[v]), integral)
            count = count + F.when(x.isNull(), 0).otherwise(1)
            totals.append(total)
            counts.append(count)
        steps |= {f"{v}_ts": F.array(*totals), f"{v}_tc": F.array(*counts)}
    prior = prior.select("_key", *[f"{v}_p{k}" for v in values for k in "sc"], *[c.alias(k) for k, c in steps.items()])

    # 4. both parts; the frame's length inside the chunk says how many rows come from before it
    joined = rows.join(prior, F.col("_chunk") == F.col("_key"))
    missing = F.greatest(F.lit(n) - (F.col("_rn") + end), F.lit(0)) + 1
    out = {}
    for m, (v, (_, integral)) in zip(metrics, values.items(), strict=True):
        r, s = _names(m)
        none = F.lit(0).cast("bigint")
        out[s] = _ratio(_add(F.coalesce(f"{v}_es", zero[v]), F.coalesce(f"{v}_ps", zero[v]), integral),
                        F.coalesce(f"{v}_ec", none) + F.coalesce(f"{v}_pc", none), integral)
        out[r] = _ratio(_add(F.coalesce(f"{v}_ls", zero[v]), F.element_at(f"{v}_ts", missing), integral),
                        F.coalesce(f"{v}_lc", none) + F.element_at(f"{v}_tc", missing), integral)
    names = [x for m in metrics for x in _names(m)]
    return joined.select(*kept, *[out[k].alias(k) for k in names])


def add_trailing_avg(df: DataFrame, metrics: Sequence[schemas.RollingMetric] = schemas.ALL_METRICS,
                     recent: int = schemas.RECENT_GAMES, order: Sequence[str] = DEFAULT_ORDER,
                     season: str = "season", strategy: str = "scan", as_of: str = "before_game",
                     columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``{metric}_recent_avg`` and ``{metric}_season_avg`` for each metric,
    partitioned by the metric's entity (``posteam`` or ``defteam``) and season.

    The first of ``order`` (the week) cuts an (entity, season) into chunks for
    ``scan``; the whole of ``order`` should order a team's games without ties.  ``columns``
    are those of ``df`` to return (None: all); the others are not moved.
    """
    passes = {"scan": _scan_pass, "window": _window_pass}
    if strategy not in passes:
        raise ValueError(f"unknown strategy {strategy!r}")
    groups = by_entity(metrics)
    if columns is not None and len(groups) > 1:
        raise ValueError("columns are chosen for the metrics of one entity")
    out = df
    for entity, ms in groups.items():
        more = {"source": None if out is df else df} if strategy == "scan" else {}
        out = passes[strategy](out, entity, ms, recent, list(order), season, _ends(as_of), columns or out.columns, **more)
    return out


def rolling_offense(team_games: DataFrame, recent: int = schemas.RECENT_GAMES,
                    order: Sequence[str] = DEFAULT_ORDER, strategy: str = "scan",
                    as_of: str = "before_game") -> DataFrame:
    """W1 + W2: offence form of the row's ``posteam``."""
    return add_trailing_avg(team_games, schemas.OFFENSE_METRICS, recent, order, strategy=strategy, as_of=as_of)


def rolling_defense(team_games: DataFrame, recent: int = schemas.RECENT_GAMES,
                    order: Sequence[str] = DEFAULT_ORDER, strategy: str = "scan",
                    as_of: str = "before_game") -> DataFrame:
    """W3 + W4: defence form of the row's ``defteam`` (the offence's opponent)."""
    return add_trailing_avg(team_games, schemas.DEFENSE_METRICS, recent, order, strategy=strategy, as_of=as_of)


def team_form(team_games: DataFrame, recent: int = schemas.RECENT_GAMES,
              order: Sequence[str] = DEFAULT_ORDER, strategy: str = "scan",
              as_of: str = "before_game") -> DataFrame:
    """All 18 trailing columns."""
    return add_trailing_avg(team_games, schemas.ALL_METRICS, recent, order, strategy=strategy, as_of=as_of)
