"""End-to-end jobs over CSV files written by the test, and the streaming ingest."""

import csv
import gzip
import os

from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.operators.quality import null_profile, stored_profile
from gridcast.plans import jobs
from gridcast.sources.files import header_catalogue, read_footers, read_gold, read_headed_csv, read_layer, read_plays_csv, write_layer
from gridcast.streaming.ingest import stream_plays_to_silver
from tests.fixtures import PLAY_COLS, bronze_plays


def _write_bronze(spark, root):
    os.makedirs(root, exist_ok=True)
    rows = [r.asDict() for r in bronze_plays(spark).collect()]
    for season in ("2020", "2021"):
        with open(f"{root}/play_by_play_{season}.csv", "w", newline="") as f:
            w = csv.DictWriter(f, fieldnames=["extra_col"] + PLAY_COLS)
            w.writeheader()
            for r in rows:
                if r["season"] == season:
                    w.writerow({"extra_col": "x", **{k: ("" if v is None else v) for k, v in r.items()}})


def _write_odds(path):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["schedule_date", "schedule_season", "schedule_week", "team_home", "team_away",
                    "team_favorite_id", "spread_favorite", "over_under_line"])
        w.writerow(["x", 2020, 1, "Kansas City Chiefs", "Buffalo Bills", "KC", -3.5, 44])
        w.writerow(["x", 2020, 2, "Buffalo Bills", "Kansas City Chiefs", "", 1.0, ""])


def test_csv_reader_matches_by_header(spark, tmp_dir):
    _write_bronze(spark, f"{tmp_dir}/bronze")
    df = read_plays_csv(spark, f"{tmp_dir}/bronze", seasons=[2020, 2021])
    assert df.columns == list(schemas.BRONZE_PLAY_COLUMNS)
    assert df.count() == 13
    assert df.where(F.col("play_type") == "kickoff").first().game_id == "g1"


def test_silver_gold_jobs(spark, tmp_dir):
    _write_bronze(spark, f"{tmp_dir}/bronze")
    _write_odds(f"{tmp_dir}/odds.csv")
    rep = jobs.bronze_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/odds.csv", f"{tmp_dir}/silver")
    assert rep["silver_plays_rows"] == 11 and rep["silver_odds_rows"] == 2
    # restating one season leaves the other untouched
    jobs.bronze_to_silver(spark, f"{tmp_dir}/bronze", None, f"{tmp_dir}/silver", seasons=[2021])
    per = {r.season: r["count"] for r in read_layer(spark, f"{tmp_dir}/silver/play_by_play").groupBy("season").count().collect()}
    assert per == {2020: 9, 2021: 2}
    out = jobs.silver_to_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold")
    assert out["gold_rows"] == 4


def test_streaming_ingest_restates_seasons(spark, tmp_dir):
    _write_bronze(spark, f"{tmp_dir}/bronze")
    q = stream_plays_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                               checkpoint=f"{tmp_dir}/ckpt")
    q.awaitTermination(300)
    silver = read_layer(spark, f"{tmp_dir}/silver")
    assert silver.count() == 11
    assert sorted(r.season for r in silver.select("season").distinct().collect()) == [2020, 2021]
    # a second run with no new files processes nothing and changes nothing
    q2 = stream_plays_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", checkpoint=f"{tmp_dir}/ckpt")
    q2.awaitTermination(300)
    assert read_layer(spark, f"{tmp_dir}/silver").count() == 11


def _plays_file(path, rows, columns):
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=columns)
        w.writeheader()
        w.writerows({k: ("" if v is None else v) for k, v in r.items()} for r in rows)


def test_files_are_read_by_their_own_headers(spark, tmp_dir):
    rows = [r.asDict() for r in bronze_plays(spark).collect()]
    _plays_file(f"{tmp_dir}/a.csv", rows[:7], PLAY_COLS)
    _plays_file(f"{tmp_dir}/b.csv", rows[7:10], PLAY_COLS[::-1])
    less = [c for c in PLAY_COLS if c != "wp"]
    _plays_file(f"{tmp_dir}/c.csv", [{k: v for k, v in r.items() if k != "wp"} for r in rows[10:]], [*less, "more"])
    got = sorted(tuple(r) for r in read_plays_csv(spark, tmp_dir).fillna("").collect())
    want = sorted(tuple("" if r[c] is None or (c == "wp" and i >= 10) else r[c] for c in schemas.BRONZE_PLAY_COLUMNS) for i, r in enumerate(rows))
    assert got == want
    assert "more" in read_plays_csv(spark, tmp_dir, all_columns=True).columns


def test_jobs_follow_from_headers_not_files(spark, tmp_dir):
    for i in range(40):
        with open(f"{tmp_dir}/{i:02d}.csv", "w") as f:
            f.write(("" if i % 2 else "\n") + ("a,b\n1,2\n" if i % 4 < 2 else 'b,"c d"\r\n3,4\r\n'))
    with gzip.open(f"{tmp_dir}/z.csv.gz", "wt") as f:
        f.write("a,b\n5,6\n")
    assert sorted(len(x) for x in header_catalogue(spark, [tmp_dir]).values()) == [20, 21]
    spark.sparkContext.setJobGroup("headers", "headers")
    df = read_headed_csv(spark, [tmp_dir])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2 * 2
    got = sorted((r.a or "", r.b or "", r["c d"] or "") for r in df.collect())
    assert got == [("", "3", "4")] * 20 + [("1", "2", "")] * 20 + [("5", "6", "")]


def test_stored_layer_is_profiled_from_footers(spark, tmp_dir):
    rows = [(1, None, "x", 2020), (2, 0.5, None, 2020), (3, None, None, 2021), (4, None, "y", None)]
    df = spark.createDataFrame(rows, "play_id int, `odd.name` double, game_id string, season int")
    write_layer(df, f"{tmp_dir}/layer")
    found = stored_profile(read_footers(spark, f"{tmp_dir}/layer"), "silver")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedGroupBy: [season]" in plan
    got = {r.column_name: (r.position, r.data_type, r.n_rows, r.null_count) for r in found.collect()}
    assert got == {"play_id": (1, "int", 4, 0), "odd.name": (2, "double", 4, 3), "game_id": (3, "string", 4, 2), "season": (4, "int", 4, 1)}
    assert {r.column_name: r.null_count for r in null_profile(df).collect()} == {c: n for c, (*_, n) in got.items() if n}
    # a layer without partitions and without rows; the session's own reader stays as it was
    df.drop("season").where("false").write.parquet(f"{tmp_dir}/none")
    got = stored_profile(read_footers(spark, f"{tmp_dir}/none"), "none").collect()
    assert [(r.column_name, r.n_rows, r.null_count) for r in got] == [("play_id", 0, 0), ("odd.name", 0, 0), ("game_id", 0, 0)]
    assert "FileScan" in spark.read.parquet(f"{tmp_dir}/none")._jdf.queryExecution().executedPlan().toString()


def test_streaming_ingest_of_a_season_in_many_files(spark, tmp_dir):
    """One file a batch, several files a season, copies of a play and null seasons
    spread over them, a restart in between: silver is the batch job's result."""
    rows = [r.asDict() for r in bronze_plays(spark).collect()]
    rows[8] = rows[8] | {"season": None, "game_id": "gx"}
    os.makedirs(f"{tmp_dir}/bronze")
    parts = [rows[i::4] for i in range(4)]

    def run():
        stream_plays_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", checkpoint=f"{tmp_dir}/ckpt",
                               max_files_per_trigger=1).awaitTermination(300)

    for i, part in enumerate(parts):
        _plays_file(f"{tmp_dir}/bronze/play_by_play_{i}.csv", part, PLAY_COLS if i % 2 else PLAY_COLS[::-1])
        if i == 2:
            run()
    run()
    jobs.bronze_to_silver(spark, f"{tmp_dir}/bronze", None, f"{tmp_dir}/batch")
    rows_of = lambda p: sorted(map(repr, (tuple(r) for r in read_layer(spark, p).select(*sorted(read_layer(spark, p).columns)).collect())))
    assert rows_of(f"{tmp_dir}/silver") == rows_of(f"{tmp_dir}/batch/play_by_play") and len(rows_of(f"{tmp_dir}/silver")) == 11


def test_train_and_score_jobs(spark, tmp_dir):
    """S4 and the train and score jobs over a written gold table and a request file."""
    import random
    _write_bronze(spark, f"{tmp_dir}/bronze")
    _write_odds(f"{tmp_dir}/odds.csv")
    jobs.bronze_to_silver(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/odds.csv", f"{tmp_dir}/silver")
    jobs.silver_to_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold")
    r = random.Random(1)
    gold = read_gold(spark, f"{tmp_dir}/gold")
    one = gold.limit(1).drop("game_id", "home_win", "season")
    keys = spark.createDataFrame([(f"n{i}", i % 2, r.choice([2020, 2021, 2023, 2024])) for i in range(40)], "game_id string, home_win int, season int")
    more = keys.join(F.broadcast(one), F.lit(True)).select(*gold.columns)
    gold.unionByName(more).write.parquet(f"{tmp_dir}/more")
    rep = jobs.train(spark, f"{tmp_dir}/more", f"{tmp_dir}/models", max_iter=2)
    assert rep["features"] == 39 and {m["split"] for m in rep["metrics"]} == {"train", "val", "test"}
    with open(f"{tmp_dir}/asked.csv", "w") as f:
        f.write("home_team,away_team,vegas_spread,vegas_total\nA,B,-3,44\nA,nobody,1,40\n")
    jobs.score(spark, f"{tmp_dir}/more", f"{tmp_dir}/models", f"{tmp_dir}/asked.csv", f"{tmp_dir}/out")
    out = {r.away_team: r for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert out["B"].teams_known and not out["nobody"].teams_known
    assert isinstance(out["B"].recommendations, list) and out["B"].recommendation_text == "; ".join(out["B"].recommendations)
