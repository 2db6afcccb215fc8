"""Data-quality reports (A3, A4, S7): one aggregate pass each, never collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import exact_avg, to_double
from gridcast.operators.reshape import unpivot_counts


def null_profile(df: DataFrame, only_nonzero: bool = True) -> DataFrame:
    """Per-column null counts in long form, largest first.

    All counts come from one aggregate (partial aggregation per task), the wide
    single row is unpivoted, and the result has at most one row per column.
    """
    wide = df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = unpivot_counts(wide, "column_name", "null_count")
    if only_nonzero:
        long = long.where(F.col("null_count") > 0)
    return long.orderBy(F.col("null_count").desc(), F.col("column_name"))


def column_summary(df: DataFrame, cols: Sequence[str] | None = None, stddev_digits: int = 6) -> DataFrame:
    """``describe()`` as a typed long table (A4): per column the non-null count,
    mean and sample standard deviation of the values read as numbers (null for
    non-numeric text), and min/max in text order.

    The mean is exact (decimal sum / count); the standard deviation is rounded to
    ``stddev_digits`` decimals since its last bits depend on the engine.
    """
    cols = list(cols or df.columns)
    present = set(df.columns)
    parts = []
    for c in cols:
        x = F.col(f"`{c}`") if c in present else F.lit(None).cast("string")
        num = to_double(x.cast("string"))
        parts.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count(x).alias("count"),
            exact_avg(num).alias("mean"),
            F.round(F.stddev_samp(num), stddev_digits).alias("stddev"),
            F.min(x.cast("string")).alias("min"),
            F.max(x.cast("string")).alias("max"),
        ))
    return df.agg(F.array(*parts).alias("_s")).select(F.inline("_s"))


def margin_disagreements(games: DataFrame) -> DataFrame:
    """Per season, the games whose final scores (maxima over the kept plays) disagree
    with the recorded margin, and those where one of the three is missing (Q15)."""
    h, a, m = F.col("final_home_score"), F.col("final_away_score"), F.col("final_home_margin")
    return games.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_games"), F.count_if(h - a != m).alias("n_disagree"),
        F.count_if(h.isNull() | a.isNull() | m.isNull()).alias("n_unknown"))


def layer_report(df: DataFrame, layer: str) -> DataFrame:
    """Row and column count of one layer (S7) as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def stored_profile(footers: DataFrame, layer: str, partition_cols: Sequence[str] = ("season",)) -> DataFrame:
    """Schema and null counts of a layer on disk (A3, S7): layer, position, column_name,
    data_type, n_rows, null_count, one row per column.

    ``footers`` is the layer from :func:`gridcast.sources.files.read_footers`.  The
    counts by partition come from footers; what is summed is a row a file.  A layer
    with nested columns is scanned for them instead, with equal results.
    """
    parts = [c for c in partition_cols if c in footers.columns]
    data = [c for c in footers.columns if c not in parts]
    total = F.count(F.lit(1)).alias("_n")
    per = footers.groupBy(*[F.col(f"`{c}`") for c in parts]).agg(total, *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(data)])
    nulls = {c: F.sum(F.col("_n") - F.col(f"_c{i}")) for i, c in enumerate(data)}
    nulls |= {c: F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_n"))) for c in parts}
    zero = F.lit(0).cast("long")
    rows = [F.struct(F.lit(layer).alias("layer"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.coalesce(F.sum("_n"), zero).alias("n_rows"), F.coalesce(nulls[f.name], zero).alias("null_count"))
            for i, f in enumerate(footers.schema.fields, 1)]
    return per.agg(F.array(*rows).alias("_s")).select(F.inline("_s"))
