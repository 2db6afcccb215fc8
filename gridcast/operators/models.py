"""Boosted-tree models of games (M2-M9, K3).

One fit learns the targets it is asked for on one binned table (``boosting``), and
one pass over a table adds the predictions of all of them.  Training, prediction and
evaluation stay on the cluster: the gold table is never collected.  A saved model is
its trees and a manifest with the feature names in order, the settings and what was
measured; loading checks the one against the other and against the features that the
caller is going to offer.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.boosting import Forest, Settings, Target, fit_forests, to_bins, walk
from gridcast.sources.files import delete_path, path_exists, rename_path

#: What can be learned, and the columns that its prediction adds.
TARGETS = {
    "win": Target("win", "home_win", "log"),
    "total": Target("total", "final_total_score"),
    "spread": Target("spread", "final_home_margin"),
}
PREDICTIONS = {"win": ("pred_home_win", "prob_home_win"), "total": ("pred_total",), "spread": ("pred_spread",)}
ORIGINAL = Settings(schemas.GBT_MAX_ITER, schemas.GBT_MAX_DEPTH, schemas.GBT_STEP_SIZE, schemas.GBT_SUBSAMPLE, schemas.GBT_SEED)


@dataclass
class GameModel:
    """Forests of some targets over one ordered list of features."""
    features: list[str]
    edges: list[np.ndarray]
    targets: list[Target]
    forests: list[Forest]
    settings: Settings
    metrics: dict = field(default_factory=dict)

    def only(self, *names: str) -> GameModel:
        at = [i for i, t in enumerate(self.targets) if t.name in names]
        return replace(self, targets=[self.targets[i] for i in at], forests=[self.forests[i] for i in at])

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Sums of the trees by row and target."""
        bins = to_bins(values, self.edges)
        out = np.stack([np.full(len(bins), f.base) for f in self.forests], 1)
        for k, f in enumerate(self.forests):
            f.add_to(out[:, k], bins)
        return out

    def fingerprint(self) -> str:
        """Digest of the features and trees, which a saved model has to have."""
        h = hashlib.sha256(json.dumps([self.features, [e.tolist() for e in self.edges]]).encode())
        for f in self.forests:
            for a in (f.feature, f.cut, f.leaf):
                h.update(np.ascontiguousarray(a).tobytes())
        return h.hexdigest()


def _values(features: Sequence[str]):
    """The features as one struct, missing ones as 0: training and serving fill alike (Q6)."""
    return F.struct(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(features)])


def check_features(model: GameModel, df: DataFrame) -> None:
    """A table must have all features of the model."""
    if missing := [c for c in model.features if c not in df.columns]:
        raise ValueError(f"the table lacks features of the model: {', '.join(missing)}")


# --- fit --------------------------------------------------------------------

def fit_games(df: DataFrame, features: Sequence[str], names: Sequence[str] = tuple(TARGETS), labels: Mapping[str, str] | None = None,
              max_iter: int = schemas.GBT_MAX_ITER, depth: int = schemas.GBT_MAX_DEPTH, rate: float = schemas.GBT_STEP_SIZE,
              subsample: float = schemas.GBT_SUBSAMPLE, seed: int = schemas.GBT_SEED, early_stop: bool = False, **more) -> GameModel:
    """Fit the named targets on the training rows together (M3-M5).  With
    ``early_stop`` each keeps the rounds after which its loss on the validation rows
    is least."""
    targets = [replace(TARGETS[n], label=(labels or {}).get(n, TARGETS[n].label)) for n in names]
    settings = Settings(max_iter, depth, rate, subsample, seed, **more)
    edges, forests = fit_forests(df.where(F.col("split") == "train"), features, targets, settings)
    model = GameModel(list(features), edges, targets, forests, settings)
    return _stopped(model, df.where(F.col("split") == "val")) if early_stop else model


def _stopped(model: GameModel, held_out: DataFrame) -> GameModel:
    """Each forest up to the round of least loss on the held-out rows, in one pass."""
    labels = [F.col(f"`{t.label}`").cast("double").alias(f"y{k}") for k, t in enumerate(model.targets)]
    rounds = model.settings.rounds
    sent = held_out.sparkSession.sparkContext.broadcast(model)

    def losses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for frame in frames:
            bins = to_bins(np.stack(frame.iloc[:, 0].to_numpy()), m.edges)
            for k, (t, f) in enumerate(zip(m.targets, m.forests, strict=True)):
                y = frame[f"y{k}"].to_numpy(np.float64)
                use = ~np.isnan(y)
                margin, loss = np.full(len(y), f.base), np.zeros(rounds + 1)
                for r in range(rounds + 1):
                    loss[r] = (np.logaddexp(0, margin) - y * margin if t.loss == "log" else (margin - y) ** 2)[use].sum()
                    if r < rounds:
                        margin += f.leaf[r][walk(bins, f.feature[r], f.cut[r], m.settings.depth)]
                yield pd.DataFrame({"k": k, "r": np.arange(rounds + 1), "loss": loss})
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in model.features]).alias("x")
    table = held_out.select(values, *labels).mapInPandas(losses, "k int, r int, loss double")
    best = table.groupBy("k", "r").agg(F.sum("loss").alias("loss")).groupBy("k").agg(F.min_by("r", F.struct("loss", "r")).alias("r"))
    at = {row.k: row.r for row in best.collect()}   # a row per target
    return replace(model, forests=[f.part(0, at.get(k)) for k, f in enumerate(model.forests)])


def fit_home_win(df: DataFrame, features: Sequence[str], label: str = "home_win", **kw) -> GameModel:
    """Boosted trees for the home win (M3), log loss."""
    return fit_games(df, features, ("win",), {"win": label}, **kw)


def fit_total(df: DataFrame, features: Sequence[str], label: str = "final_total_score", **kw) -> GameModel:
    """Boosted trees for total points (M4)."""
    return fit_games(df, features, ("total",), {"total": label}, **kw)


def fit_margin(df: DataFrame, features: Sequence[str], label: str = "final_home_margin", **kw) -> GameModel:
    """Boosted trees for the home margin (M5)."""
    return fit_games(df, features, ("spread",), {"spread": label}, **kw)


# --- apply ------------------------------------------------------------------

def predict(model: GameModel, df: DataFrame) -> DataFrame:
    """Add the predictions of all targets in one pass (M6): class and probability of a
    home win, total, margin."""
    check_features(model, df)
    names = [c for t in model.targets for c in PREDICTIONS[t.name]]
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(", ".join(f"{c} double" for c in names))
    def scores(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for x in parts:
            out = {}
            for t, margin in zip(m.targets, m.margins(x.to_numpy(np.float64)).T, strict=True):
                if t.loss == "log":
                    p = 1 / (1 + np.exp(-margin))
                    out |= dict(zip(PREDICTIONS[t.name], ((p > 0.5).astype(np.float64), p), strict=True))
                else:
                    out |= {PREDICTIONS[t.name][0]: margin}
            yield pd.DataFrame(out)
    taken = "_scores"
    while taken in df.columns:
        taken = f"_{taken}"
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.withColumn(taken, scores(_values(model.features))).select(*kept, *[F.col(f"{taken}.{c}").alias(c) for c in names])


def residuals(pred: DataFrame, label: str, prediction: str, split: str = "test") -> DataFrame:
    """(actual, predicted, residual) of one split: the data behind a scatter chart (M8)."""
    df = pred.where(F.col("split") == split) if split else pred
    return df.select("game_id", "season", F.col(label).cast("double").alias("actual"),
                     F.col(prediction).alias("predicted"),
                     (F.col(prediction) - F.col(label)).alias("residual"))


def feature_importances(model: GameModel, target: str = "win") -> list[tuple[str, float]]:
    """(feature, importance) pairs: a feature's share of the gain of all splits."""
    (f,) = model.only(target).forests
    gain = np.bincount(f.feature.ravel(), f.gain.ravel(), len(model.features))
    whole = gain.sum()
    return [(c, float(g / whole) if whole else 0.0) for c, g in zip(model.features, gain, strict=True)]


def top_importances(model: GameModel, n: int = schemas.TOP_IMPORTANCES, target: str = "win", spark: SparkSession | None = None) -> DataFrame:
    """The ``n`` largest feature importances (K3).  The table has one row per
    feature (39), so it is built on the driver by nature."""
    spark = spark or SparkSession.getActiveSession()
    df = spark.createDataFrame(feature_importances(model, target), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(n)


# --- save and load ----------------------------------------------------------

_TREES = "target string, tree int, feature array<int>, cut array<int>, gain array<double>, leaf array<double>"


def save_model(model: GameModel, path: str, spark: SparkSession | None = None) -> None:
    """Write the trees and the manifest under a temporary name and rename them: a
    model is there whole or not at all (M9)."""
    spark = spark or SparkSession.getActiveSession()
    rows = [(t.name, i, f.feature[i].tolist(), f.cut[i].tolist(), f.gain[i].tolist(), f.leaf[i].tolist())
            for t, f in zip(model.targets, model.forests, strict=True) for i in range(len(f))]
    manifest = {"features": model.features, "edges": [e.tolist() for e in model.edges], "targets": [asdict(t) for t in model.targets],
                "bases": [f.base for f in model.forests], "settings": asdict(model.settings), "metrics": model.metrics, "fingerprint": model.fingerprint()}
    part = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    spark.createDataFrame(rows, _TREES).coalesce(1).write.parquet(f"{part}/trees")
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1).write.text(f"{part}/manifest")
    if path_exists(spark, path):
        delete_path(spark, path)
    rename_path(spark, part, path)


def load_model(path: str, features: Sequence[str] | None = None, spark: SparkSession | None = None) -> GameModel:
    """Read a model (M9).  ``features`` are those the caller offers, in order: the
    model must have been trained on just these."""
    spark = spark or SparkSession.getActiveSession()
    m = json.loads("".join(r.value for r in spark.read.text(f"{path}/manifest").collect()))
    if features is not None and list(features) != m["features"]:
        gone, new = [c for c in m["features"] if c not in features], [c for c in features if c not in m["features"]]
        raise ValueError(f"the model at {path} was trained on other features: "
                         + (f"missing {gone}, unknown {new}" if gone or new else "the same in another order"))
    by: dict[str, list] = {t["name"]: [] for t in m["targets"]}
    for r in spark.read.parquet(f"{path}/trees").collect():   # rounds x targets, whatever the games
        by[r.target].append(r)
    forests = []
    for t, base in zip(m["targets"], m["bases"], strict=True):
        rows = sorted(by[t["name"]], key=lambda r: r.tree)
        empty = Forest.empty(base, m["settings"]["depth"])
        forests.append(Forest(base, np.array([r.feature for r in rows], np.int16), np.array([r.cut for r in rows], np.uint8),
                              np.array([r.gain for r in rows]), np.array([r.leaf for r in rows])) if rows else empty)
    model = GameModel(m["features"], [np.array(e, np.float64) for e in m["edges"]], [Target(**t) for t in m["targets"]], forests,
                      Settings(**m["settings"]), m["metrics"])
    if model.fingerprint() != m["fingerprint"]:
        raise ValueError(f"the trees at {path} are not those of its manifest")
    return model
