"""End-to-end jobs (the only place actions run), argument driven.

    python -m gridcast.plans.jobs silver --plays BRONZE_PBP_DIR --odds ODDS_CSV --out SILVER_ROOT
    python -m gridcast.plans.jobs gold   --silver SILVER_ROOT --out GOLD_DIR
    python -m gridcast.plans.jobs train  --gold GOLD_DIR --models MODELS_DIR
    python -m gridcast.plans.jobs score  --gold GOLD_DIR --models MODELS_DIR --matchups CSV --out DIR

No master, paths or seasons are hard-coded; spark-submit supplies the cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.features import select_features
from gridcast.operators.metrics import chrono_split, evaluate
from gridcast.operators.models import fit_games, load_model, predict, save_model, top_importances
from gridcast.operators.scoring import score_matchups
from gridcast.operators.silver import clean_odds, clean_plays
from gridcast.plans.gold import GoldOptions, build_gold
from gridcast.session import build_session, materialize
from gridcast.sources.files import (read_gold, read_layer, read_odds_csv, read_plays_csv,
                                    write_layer, write_season)


def bronze_to_silver(spark: SparkSession, plays_path: str, odds_path: str | None, out_root: str,
                     seasons=None, literal: bool = False) -> dict:
    """Bronze CSV -> silver parquet (plays restated per season, odds overwritten)."""
    keep = schemas.LITERAL_KEEP_TYPES if literal else schemas.KEEP_TYPES
    bronze = read_plays_csv(spark, plays_path, seasons, all_columns=True)
    silver = clean_plays(bronze, keep)
    obs = Observation("silver_plays")   # row count gathered by the write itself, no extra pass
    write_season(silver, f"{out_root}/play_by_play", observation=obs)
    report = {"silver_plays_rows": obs.get["rows"], "silver_plays_columns": len(silver.columns)}
    if odds_path:
        oobs = Observation("silver_odds")
        weeks = None if literal else schemas.LAST_REGULAR_WEEK
        write_layer(clean_odds(read_odds_csv(spark, odds_path), last_regular=weeks), f"{out_root}/odds", within=("week",),
                    observation=oobs)
        report["silver_odds_rows"] = oobs.get["rows"]
    return report


def silver_to_gold(spark: SparkSession, silver_root: str, out: str, seasons=None,
                   literal: bool = False) -> dict:
    """Silver plays + odds -> gold games, partitioned by season."""
    plays = read_layer(spark, f"{silver_root}/play_by_play", seasons)
    odds = read_layer(spark, f"{silver_root}/odds", seasons)
    opts = GoldOptions.literal() if literal else GoldOptions()
    obs = Observation("gold_games")
    (write_season if seasons else write_layer)(build_gold(plays, odds, opts), out, observation=obs)
    return {"gold_rows": obs.get["rows"]}


def train(spark: SparkSession, gold_path: str, models_dir: str, train_to: int = schemas.TRAIN_TO_SEASON,
          val: int = schemas.VAL_SEASON, max_iter: int = schemas.GBT_MAX_ITER,
          early_stop: bool = False) -> dict:
    """Fit the three targets on the chronological split, save the model, report metrics."""
    gold = read_gold(spark, gold_path)
    feats = select_features(gold)
    data = materialize(chrono_split(gold, train_to, val), "training_gold")
    model = fit_games(data, feats, max_iter=max_iter, early_stop=early_stop)
    metrics = [r.asDict() for r in evaluate(predict(model, data)).collect()]          # one row per split
    model.metrics = {r["split"]: {k: r[k] for k in ("accuracy", "mae_spread", "mae_total")} for r in metrics if r["split"]}
    save_model(model, models_dir, spark)
    top = [r.asDict() for r in top_importances(model, spark=spark).collect()]
    return {"features": len(feats), "metrics": metrics, "top_importances": top}


def score(spark: SparkSession, gold_path: str, models_dir: str, matchups_path: str, out: str) -> None:
    """Score a table of matchups (home_team, away_team, vegas_spread, vegas_total)."""
    matchups = (spark.read.option("header", "true").csv(matchups_path)
                .withColumns({"vegas_spread": F.col("vegas_spread").try_cast("double"),
                              "vegas_total": F.col("vegas_total").try_cast("double")}))
    gold = read_gold(spark, gold_path)
    model = load_model(models_dir, select_features(gold), spark)
    scored = score_matchups(matchups, gold, model)
    scored.write.mode("overwrite").parquet(out)   # recommendations as an array and as text


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="gridcast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--plays", required=True)
    s.add_argument("--odds")
    s.add_argument("--out", required=True)
    s.add_argument("--seasons", type=int, nargs="*")
    s.add_argument("--literal", action="store_true")
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--seasons", type=int, nargs="*")
    g.add_argument("--literal", action="store_true")
    t = sub.add_parser("train")
    t.add_argument("--gold", required=True)
    t.add_argument("--models", required=True)
    t.add_argument("--max-iter", type=int, default=schemas.GBT_MAX_ITER)
    t.add_argument("--early-stop", action="store_true")
    c = sub.add_parser("score")
    c.add_argument("--gold", required=True)
    c.add_argument("--models", required=True)
    c.add_argument("--matchups", required=True)
    c.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = build_session(app_name=f"gridcast-{a.cmd}")
    if a.cmd == "silver":
        out = bronze_to_silver(spark, a.plays, a.odds, a.out, a.seasons or None, a.literal)
    elif a.cmd == "gold":
        out = silver_to_gold(spark, a.silver, a.out, a.seasons or None, a.literal)
    elif a.cmd == "train":
        out = train(spark, a.gold, a.models, max_iter=a.max_iter, early_stop=a.early_stop)
    else:
        score(spark, a.gold, a.models, a.matchups, a.out)
        out = {"written": a.out}
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
