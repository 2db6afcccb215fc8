"""Feature selection and assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast import schemas

FILLED_PREFIX = "__f_"


def select_features(df: DataFrame) -> list[str]:
    """Trailing-average columns (names containing ``_avg``) plus the three odds
    columns, in table order (P13).  ``avg_epa_per_play`` does not contain
    ``_avg``, so the same-game aggregate never leaks into the features."""
    return [c for c in df.columns if "_avg" in c or c in schemas.ODDS_FEATURES]


def prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    """Column names starting with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]


def fill_missing(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Nulls in ``cols`` -> ``value``."""
    return df.na.fill(value, subset=list(cols)) if cols else df


def fill_stage(features: Sequence[str], value: float = 0.0) -> Transformer:
    """Pipeline stage writing ``coalesce(f, value)`` to ``__f_<f>``, so training and
    serving fill the same way (quirk Q6)."""
    cols = ", ".join(f"coalesce(cast(`{c}` as double), {float(value)}D) AS `{FILLED_PREFIX}{c}`"
                     for c in features)
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def assemble_features(features: Sequence[str], output: str = "features") -> list[Transformer]:
    """Fill + ``VectorAssembler`` over a fixed, ordered feature list (M2)."""
    return [fill_stage(features),
            VectorAssembler(inputCols=[f"{FILLED_PREFIX}{c}" for c in features], outputCol=output)]


def feature_matrix(df: DataFrame, features: Sequence[str] | None = None,
                   keep: Sequence[str] = ("game_id", "season", "home_win", "final_home_margin",
                                          "final_total_score")) -> DataFrame:
    """Keys, labels and filled feature columns as a plain table (P13 + P14)."""
    features = list(features or select_features(df))
    return fill_missing(df.select(*[F.col(c) for c in list(keep) + features]), features, 0.0)
