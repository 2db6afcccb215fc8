"""Trailing form: both strategies against a brute-force reference, leak-freedom,
season resets, and a hot group split over many chunks."""

import random
from decimal import Decimal

import pytest

from gridcast import schemas
from gridcast.operators.rolling import add_trailing_avg

METRICS = (schemas.RollingMetric("pts", "pts", "team"),
           schemas.RollingMetric("epa", "epa", "team"),
           schemas.RollingMetric("neg_epa", "epa", "team", negate=True))


def _data(n_rows=400, seed=7, hot="T0"):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_rows):
        team = hot if rnd.random() < 0.5 else f"T{rnd.randint(1, 4)}"
        season = rnd.choice([2020, 2021])
        pts = None if rnd.random() < 0.1 else rnd.randint(0, 40)
        epa = None if rnd.random() < 0.1 else round(rnd.uniform(-1, 1), 4)
        rows.append((team, season, rnd.randint(1, 18), f"g{i:05d}", pts, epa))
    return rows


def _brute(rows, recent=4, after=0):
    """Reference: per (team, season) in (week, game_id) order, averages of the
    previous ``recent`` rows and of all previous rows (nulls ignored); ``after=1``
    counts the current row in."""
    out = {}
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[2], r[3]))
        for i, r in enumerate(g):
            res = {}
            for name, idx, sign in (("pts", 4, 1), ("epa", 5, 1), ("neg_epa", 5, -1)):
                def avg(seq):
                    vals = [Decimal(str(x[idx])) * sign for x in seq if x[idx] is not None]
                    return float(sum(vals)) / len(vals) if vals else None
                res[f"{name}_recent_avg"] = avg(g[max(0, i + after - recent):i + after])
                res[f"{name}_season_avg"] = avg(g[:i + after])
            out[r[3]] = res
    return out


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "team string, season int, week int, game_id string, pts int, epa double")
    res = add_trailing_avg(df, METRICS, recent=4, **kw).collect()
    return {r.game_id: r.asDict() for r in res}


def _check(got, want):
    assert set(got) == set(want)
    for gid, exp in want.items():
        for k, v in exp.items():
            g = got[gid][k]
            if v is None:
                assert g is None, (gid, k, g)
            else:
                assert g == pytest.approx(v, rel=1e-12, abs=1e-12), (gid, k, g, v)


@pytest.mark.parametrize("strategy", ["window", "scan"])
@pytest.mark.parametrize("as_of", ["before_game", "after_latest"])
def test_strategies_match_brute_force(spark, strategy, as_of):
    rows = _data()
    _check(_run(spark, rows, strategy=strategy, as_of=as_of), _brute(rows, after=int(as_of == "after_latest")))


def test_few_rows_in_a_chunk_reach_over_several(spark):
    """One game a week: every look-back of four crosses four chunks."""
    rows = [("A", 2020, w, f"g{w:02d}", w if w % 5 else None, w / 8) for w in range(1, 15)]
    _check(_run(spark, rows, strategy="scan"), _brute(rows))


def test_null_keys_are_a_group_of_their_own(spark):
    rows = [(None, 2020, 1, "a", 1, 0.5), (None, 2020, 2, "b", 3, 0.5), ("A", None, 2, "c", 5, 0.5), ("A", None, None, "d", 7, 0.5)]
    a, b = (_run(spark, rows, strategy=s) for s in ("window", "scan"))
    assert a == b and b["b"]["pts_season_avg"] == 1.0


def test_hot_team_season_spreads_over_tasks_and_nothing_runs_early(spark):
    """A team-season with half of all rows: its rows end in many partitions, and
    building the plan starts no job."""
    rows = _data(2000)
    df = spark.createDataFrame(rows, "team string, season int, week int, game_id string, pts int, epa double")
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    out = add_trailing_avg(df, METRICS, recent=4)
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("running", "running")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # else so few rows are put into one task
    try:
        from pyspark.sql import functions as F
        per = out.where("team = 'T0' and season = 2020").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    assert len(per) >= 6


def test_scan_equals_window_exactly(spark):
    rows = _data(seed=11)
    a = _run(spark, rows, strategy="window")
    b = _run(spark, rows, strategy="scan")
    assert a == b


def test_first_game_null_and_season_reset(spark):
    rows = [("A", 2020, 1, "a", 10, 0.5), ("A", 2020, 2, "b", 20, 0.5), ("A", 2021, 1, "c", 30, 0.5)]
    got = _run(spark, rows, strategy="scan")
    assert got["a"]["pts_season_avg"] is None and got["c"]["pts_season_avg"] is None
    assert got["b"]["pts_recent_avg"] == 10.0


def test_no_leak_from_later_games(spark):
    rows = _data(seed=3)
    base = _run(spark, rows, strategy="scan")
    last = max(rows, key=lambda r: (r[2], r[3]))
    changed = [r if r is not last else r[:4] + (999, 9.0) for r in rows]
    after = _run(spark, changed, strategy="scan")
    for gid in base:   # every trailing average (the changed game's own included) is unchanged
        assert {k: v for k, v in base[gid].items() if k.endswith("_avg")} == \
            {k: v for k, v in after[gid].items() if k.endswith("_avg")}
