"""Split and evaluation metrics as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.functions.columns import exact_avg


def chrono_split(df: DataFrame, train_to: int = schemas.TRAIN_TO_SEASON,
                 val: int = schemas.VAL_SEASON, season: str = "season") -> DataFrame:
    """Add ``split``: train for seasons <= ``train_to``, val for ``val``, test after (M1)."""
    s = F.col(season)
    return df.withColumn("split", F.when(s <= train_to, "train").when(s == val, "val")
                         .when(s > val, "test"))


def home_win_baseline(df: DataFrame, label: str = "home_win") -> DataFrame:
    """Share of home wins over all games (A5)."""
    return df.agg(F.count(F.lit(1)).alias("n_games"),
                  F.avg(F.col(label).cast("double")).alias("home_win_rate"))


def split_counts(df: DataFrame) -> DataFrame:
    """Games in all / train / val / test, one pass."""
    sp = F.col("split")
    return df.agg(F.count(F.lit(1)).alias("n_all"),
                  F.count_if(sp == "train").alias("n_train"),
                  F.count_if(sp == "val").alias("n_val"),
                  F.count_if(sp == "test").alias("n_test"))


def accuracy(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of exact class predictions per group."""
    hit = (F.col(pred).cast("double") == F.col(label).cast("double")).cast("int")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def mae(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), name: str = "mae") -> DataFrame:
    """Mean absolute error per group (A8), from an exact sum."""
    err = F.abs(F.col(pred).cast("double") - F.col(label).cast("double"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), exact_avg(err).alias(name))


def confusion_matrix(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """actual x predicted counts, zero-filled, classes 0 (away) and 1 (home)."""
    p = F.col(pred).cast("int")
    return df.groupBy(*by, F.col(label).cast("int").alias("actual")).agg(
        F.count_if(p == 0).alias("predicted_away"),
        F.count_if(p == 1).alias("predicted_home"))


def evaluate(df: DataFrame, by: Sequence[str] = ("split",), win_label: str = "home_win",
             win_pred: str = "pred_home_win", spread_label: str = "final_home_margin",
             spread_pred: str = "pred_spread", total_label: str = "final_total_score",
             total_pred: str = "pred_total") -> DataFrame:
    """All model-quality numbers per split in one aggregate (M7): accuracy, the
    home-win base rate, spread MAE and total MAE."""
    hit = (F.col(win_pred).cast("double") == F.col(win_label).cast("double")).cast("int")
    err_s = F.abs(F.col(spread_pred).cast("double") - F.col(spread_label).cast("double"))
    err_t = F.abs(F.col(total_pred).cast("double") - F.col(total_label).cast("double"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(hit).alias("accuracy"),
        F.avg(F.col(win_label).cast("double")).alias("home_win_rate"),
        exact_avg(err_s).alias("mae_spread"),
        exact_avg(err_t).alias("mae_total"))
