"""The trainer: splits against brute force, trees that do not depend on the layout of
the rows, quality next to Spark ML's trees, and saved models."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from gridcast.operators import boosting as b
from gridcast.operators.features import assemble_features
from gridcast.operators.models import (check_features, feature_importances, fit_games, fit_margin, load_model, predict, save_model,
                                       top_importances)

FEATURES = ["f0", "f1", "f2", "f3"]


def games(spark, n=600, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x = [r.choice([None, 0.0, r.uniform(-1, 1)]) if j == 3 else r.uniform(-1, 1) for j in range(4)]
        margin = round(10 * x[0] + (8 if x[1] > 0.2 else -3) + r.gauss(0, 2), 1)
        rows.append((i, 2020, r.choice(["train", "train", "val", "test"]), *x, int(margin > 0), margin, 40 + 5 * x[2]))
    return spark.createDataFrame(rows, "game_id long, season int, split string, f0 double, f1 double, f2 double, f3 double, "
                                       "home_win int, final_home_margin double, final_total_score double").repartition(3)


def test_best_split_against_brute_force():
    r = np.random.default_rng(3)
    bins, g, h = r.integers(0, 6, (80, 3)).astype(np.uint8), r.integers(-50, 50, 80) * b.UNIT / 10, np.full(80, b.UNIT)
    s = b.Settings(bins=8)
    node = r.integers(0, 2, 80)
    total = b.sums(bins, node, g, h, 2, 8)
    for k in range(2):
        mine = node == k
        gs, best = g[mine] / b.UNIT, (0.0, 0, b.NO_SPLIT)
        for f in range(3):
            for cut in range(7):
                left = bins[mine, f] <= cut
                if left.sum() < 1 or (~left).sum() < 1:
                    continue
                gain = sum(gs[m].sum() ** 2 / (m.sum() + 1) for m in (left, ~left)) - gs.sum() ** 2 / (len(gs) + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
        f, cut, gain, *_ = b.best_split(total[k], s)
        assert (f, cut) == best[1:] and gain == pytest.approx(best[0])


def test_trees_follow_from_the_rows_alone(spark):
    """Few or many blocks, levels grown in a task or by jobs: the same trees."""
    df = games(spark)
    targets = [b.Target("win", "home_win", "log"), b.Target("spread", "final_home_margin")]
    settings = b.Settings(rounds=4, depth=3)
    found = [b.fit_forests(d, FEATURES, targets, settings, rows) for d, rows in ((df, 10_000), (df.repartition(5), 130), (df.coalesce(1), 333))]
    for _, forests in found[1:]:
        for x, y in zip(found[0][1], forests, strict=True):
            assert len(x) == 4 and all(np.array_equal(getattr(x, k), getattr(y, k)) for k in ("feature", "cut", "gain", "leaf"))


def test_a_new_worker_catches_up():
    """A block that a worker has not seen gets all trees, and then agrees."""
    r = np.random.default_rng(1)
    arrays = (r.integers(0, 9, (50, 2)).astype(np.uint8), r.normal(size=(50, 1)), r.integers(0, 1 << 60, 50).astype(np.uint64))
    settings, target = b.Settings(rounds=3, depth=2, bins=16), b.Target("y", "y")
    forest = b.Forest.empty(0.5, 2)
    seen = b.Block("run", 0, arrays, 0, target, forest, settings)
    for _ in range(3):
        seen.begin()
        tree = b.Growing(2)
        for _ in range(2):
            tree.split({n: b.best_split(t, settings) for n, t in enumerate(seen.sums(tree)) if t[0, :, 1].any()})
        seen.apply(tree.forest(0.0))
        forest = forest.plus(tree.forest(0.0))
    fresh = b.Block("run", 1, arrays, 0, target, forest, settings)
    assert fresh.done == 3 and np.array_equal(fresh.margin, seen.margin)


def test_quality_is_that_of_spark_ml(spark):
    df = games(spark, 1500).cache()
    ours = predict(fit_margin(df, FEATURES, max_iter=25, depth=3, subsample=1.0), df)
    gbt = GBTRegressor(labelCol="final_home_margin", featuresCol="features", predictionCol="theirs", maxIter=25, maxDepth=3, stepSize=0.1, seed=42)
    both = Pipeline(stages=[*assemble_features(FEATURES), gbt]).fit(df.where("split = 'train'")).transform(ours)
    mae = both.where("split = 'test'").agg(F.avg(F.abs(F.col("pred_spread") - F.col("final_home_margin"))).alias("ours"),
                                           F.avg(F.abs(F.col("theirs") - F.col("final_home_margin"))).alias("theirs")).first()
    assert mae.ours <= 1.1 * mae.theirs


def test_joint_fit_is_the_single_fits(spark):
    df = games(spark)
    joint = fit_games(df, FEATURES, max_iter=3, depth=3)
    alone = fit_margin(df, FEATURES, max_iter=3, depth=3)
    assert joint.only("spread").fingerprint() == alone.fingerprint()
    out = predict(joint, df)
    assert [c for c in out.columns if c.startswith(("pred", "prob"))] == ["pred_home_win", "prob_home_win", "pred_total", "pred_spread"]
    a = {r.game_id: r.pred_spread for r in out.collect()}
    assert a == {r.game_id: r.pred_spread for r in predict(alone, df).collect()}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_early_stop_keeps_the_best_rounds(spark):
    df = games(spark, 200)
    whole = fit_games(df, FEATURES, max_iter=30, depth=4, rate=0.5, subsample=1.0)
    short = fit_games(df, FEATURES, max_iter=30, depth=4, rate=0.5, subsample=1.0, early_stop=True)
    val = df.where("split = 'val'").toPandas()
    x = val[FEATURES].fillna(0.0).to_numpy()
    for k, t in enumerate(whole.targets):
        y, f = val[t.label].to_numpy(), whole.forests[k]
        def loss(r):
            m = whole.only(t.name)
            m.forests = [f.part(0, r)]
            s = m.margins(x)[:, 0]
            return (np.logaddexp(0, s) - y * s if t.loss == "log" else (s - y) ** 2).sum()
        losses = [loss(r) for r in range(31)]
        assert losses[len(short.forests[k])] == pytest.approx(min(losses))
    assert min(map(len, short.forests)) < 30


def test_saved_models_and_their_manifest(spark, tmp_dir):
    df = games(spark)
    model = fit_games(df, FEATURES, max_iter=2, depth=2)
    model.metrics = {"test": {"mae_spread": 1.5}}
    for _ in range(2):   # the second replaces the first
        save_model(model, f"{tmp_dir}/m", spark)
    again = load_model(f"{tmp_dir}/m", FEATURES, spark)
    assert again.fingerprint() == model.fingerprint() and again.metrics == model.metrics and again.settings == model.settings
    with pytest.raises(ValueError, match="another order"):
        load_model(f"{tmp_dir}/m", FEATURES[::-1], spark)
    with pytest.raises(ValueError, match="missing .'f3'."):
        load_model(f"{tmp_dir}/m", FEATURES[:3], spark)
    with pytest.raises(ValueError, match="lacks features of the model: f1"):
        predict(again, df.drop("f1"))
    check_features(again, df.select(*FEATURES[::-1]))
    spark.read.parquet(f"{tmp_dir}/m/trees").where("tree = 0").write.parquet(f"{tmp_dir}/other/trees")
    spark.read.text(f"{tmp_dir}/m/manifest").write.text(f"{tmp_dir}/other/manifest")
    with pytest.raises(ValueError, match="not those of its manifest"):
        load_model(f"{tmp_dir}/other", spark=spark)


def test_importances_and_tables_without_rows(spark):
    df = games(spark)
    model = fit_games(df, FEATURES, max_iter=5, depth=3)
    shares = dict(feature_importances(model, "spread"))
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) in ("f0", "f1")
    assert [r.feature for r in top_importances(model, 2, "spread", spark).collect()] == sorted(shares, key=lambda c: (-shares[c], c))[:2]
    with pytest.raises(ValueError, match="no training rows"):
        fit_games(df.where("false"), FEATURES, max_iter=1)
    assert predict(model, df.where("false")).collect() == []


def test_only_the_smaller_child_is_counted(monkeypatch):
    """Below the root a block counts at most half of its rows a level, and has the sums
    that counting all of them gives; the grown tree is applied as any other."""
    r = np.random.default_rng(5)
    n, counted = 4000, []
    bins = r.integers(0, 16, (n, 5)).astype(np.uint8)
    labels = np.stack([bins[:, 0] * 1.5 + r.normal(size=n), (bins[:, 1] > 9).astype(float)], 1)
    key, settings, whole = r.integers(0, 1 << 60, n).astype(np.uint64), b.Settings(depth=4, bins=16), b.sums
    monkeypatch.setattr(b, "sums", lambda bins, *more: counted.append(len(bins)) or whole(bins, *more))
    for k, loss in enumerate(("squared", "log")):
        block = b.Block(f"run{k}", 0, (bins, labels, key), k, b.Target("y", "y", loss), b.Forest.empty(0.5, 4), settings)
        block.begin()
        tree = b.Growing(4)
        for level in range(4):
            counted.clear()
            total = block.sums(tree)
            node = b.walk(block.rows, tree.feature, tree.cut, level)
            assert np.array_equal(total, whole(block.rows, node, block.g, block.h, 1 << level, 16))
            assert counted[0] <= (len(block.rows) // 2 if level else len(block.rows))
            tree.split({i: b.best_split(t, settings) for i, t in enumerate(total) if t[0, :, 1].any()})
        block.grown(tree)
        fresh = b.Block(f"other{k}", 0, (bins, labels, key), k, b.Target("y", "y", loss), b.Forest.empty(0.5, 4).plus(tree.forest(0.5)), settings)
        assert np.array_equal(fresh.margin, block.margin) and fresh.done == block.done == 1


def test_rows_of_one_block_are_one_partition(spark, monkeypatch):
    """However many splits a scan makes of the binned rows, a task gets a block, so that few
    rows are learned in jobs of many rounds."""
    parts, init = [], b.Trainer.__init__
    monkeypatch.setattr(b.Trainer, "__init__", lambda self, *a: init(self, *a) or parts.append(self.parts))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        b.fit_forests(games(spark), FEATURES, [b.Target("spread", "final_home_margin")], b.Settings(rounds=2, depth=2))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert parts == [1]


def test_features_are_counted_two_at_a_time(monkeypatch):
    """Where rows are many enough two features share a count (an odd one is left alone),
    else each has its own; both are the plain sums of the rows."""
    r = np.random.default_rng(7)
    for n, nodes, calls in ((6000, 2, 6), (300, 4, 10)):   # five features, two derivatives
        bins, node = r.integers(0, 16, (n, 5)).astype(np.uint8), r.integers(0, nodes, n)
        g, h = np.rint(r.normal(size=n) * b.UNIT), np.rint(r.random(n) * b.UNIT) + 1
        plain = np.zeros((nodes, 5, 16, 2), np.int64)
        for f in range(5):
            np.add.at(plain, (node, f, bins[:, f]), np.stack([g, h], 1).astype(np.int64))
        counted, count = [], np.bincount
        with monkeypatch.context() as m:
            m.setattr(b.np, "bincount", lambda *a: counted.append(1) or count(*a))
            for chunk in (1 << 18, 1000):
                m.setattr(b, "ROWS_A_CHUNK", chunk)
                assert np.array_equal(b.sums(bins, node, g, h, nodes, 16), plain)
                assert np.array_equal(b.sums(np.asfortranarray(bins), node, g, np.full(n, b.UNIT), nodes, 16)[..., 0], plain[..., 0])
        assert len(counted) == 2 * calls * (1 + -(-n // 1000))


def test_rows_go_down_by_column():
    """Rows meet all nodes of a level at once (below eight levels one each): the leaf is that
    of going down row by row, from any level, and no look-up has a place for each row."""
    r = np.random.default_rng(8)
    for depth in (1, 4, 6, 9):
        bins = r.integers(0, 64, (b.ROWS_A_WALK + 77, 7)).astype(np.uint8)
        feature, cut = r.integers(0, 7, (1 << depth) - 1).astype(np.int16), r.choice([5, 30, 60, b.NO_SPLIT], (1 << depth) - 1).astype(np.uint8)
        at, rows, half = np.zeros(len(bins), np.int64), np.arange(len(bins)), None
        for level in range(depth):
            half = at.copy() if level == depth // 2 else half
            k = at + (1 << level) - 1
            at = 2 * at + (bins[rows, feature[k]] > cut[k])
        assert np.array_equal(b.walk(bins, feature, cut, depth), at)
        assert np.array_equal(b.descend(np.asfortranarray(bins), half, feature, cut, depth // 2, depth), at)
        forest = b.Forest(0.0, feature[None], cut[None], np.zeros((1, len(cut))), r.normal(size=(1, 1 << depth)))
        margin = np.ones(len(bins))
        forest.add_to(margin, bins)
        assert np.array_equal(margin, 1.0 + forest.leaf[0][at])


def test_counts_take_the_rows_of_a_round_where_they_are():
    """A block puts pairs of features together once; counting some of its rows from there
    gives the sums of a copy of those rows."""
    r = np.random.default_rng(9)
    bins = np.asfortranarray(r.integers(0, 16, (5000, 5)).astype(np.uint8))
    at = np.flatnonzero(r.random(5000) < 0.7)
    node, g, h = r.integers(0, 2, len(at)), np.rint(r.normal(size=len(at)) * b.UNIT), np.rint(r.random(len(at)) * b.UNIT) + 1
    columns = b.Columns.of(bins, 16)
    assert len(columns) == 5000 and columns.two.shape == (2, 5000)
    for nodes in (2, 64):   # two features a count, one a count
        assert np.array_equal(b.sums(replace(columns, at=at), node, g, h, nodes, 16), b.sums(bins[at], node, g, h, nodes, 16))


def test_rounds_of_one_block_are_few_jobs(spark, monkeypatch):
    jobs, job = [], b.Trainer._job
    monkeypatch.setattr(b.Trainer, "_job", lambda self, work: jobs.append(len(self.forests[0])) or job(self, work))
    _, (forest,) = b.fit_forests(games(spark), FEATURES, [b.Target("spread", "final_home_margin")], b.Settings(rounds=110, depth=2))
    assert jobs == [0, 100] and len(forest) == 110


def test_rows_are_binned_before_they_move(spark, monkeypatch):
    """All tasks bin the rows that they have, and a block gets bytes; no row is lost or changed."""
    plans, write = [], b.materialize
    monkeypatch.setattr(b, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    df = games(spark).where("split = 'train'")
    values, labels = [F.coalesce(F.col(c), F.lit(0.0)) for c in FEATURES], [F.col("final_home_margin")]
    edges = b.bin_edges(df, values, 16)
    table = b.binned(df, values, labels, edges, 2)
    assert plans[0].index("Repartition 2") < plans[0].index("MapInArrow")
    rows = [r for row in table.collect() for r in zip(np.frombuffer(row.labels), map(tuple, np.frombuffer(row.bins, np.uint8).reshape(-1, 4)), strict=True)]
    plain = df.select(*labels, *values).toPandas().to_numpy()
    assert sorted(rows) == sorted(zip(plain[:, 0], map(tuple, b.to_bins(plain[:, 1:], edges)), strict=True)) and len(rows) > 100


def test_blocks_of_many_rows_stay_where_they_are(spark, monkeypatch):
    """A level is a job of one stage that counts the smaller child of each node; blocks are placed
    once, found again by any worker, and placed anew where they are gone.  The trees are those of one block."""
    df, gone = games(spark), []
    targets, settings = [b.Target("win", "home_win", "log"), b.Target("spread", "final_home_margin")], b.Settings(rounds=5, depth=3)
    _, plain = b.fit_forests(df, FEATURES, targets, settings)
    asked, counted, placed, place = [], b.Trainer._counted, [], b.Trainer._place

    def count(self, k, tree, nodes):
        if (k, len(self.forests[k]), tree.level) == (1, 2, 1) and not gone:
            found = self.placed.mapPartitionsWithIndex(lambda i, it, run=self.run: [b.Placed.folder_of(run, i)] if list(it) else []).collect()
            gone.extend(found)
            for folder in found[:2]:
                b.shutil.rmtree(folder)
        asked.append((tree.level, len(nodes)))
        return counted(self, k, tree, nodes)
    monkeypatch.setattr(b.Trainer, "_counted", count)
    monkeypatch.setattr(b.Trainer, "_place", lambda self, gone=None: placed.append(gone) or place(self, gone))
    for gathered in (32, 1):   # sums to the driver as they are, or by node first
        monkeypatch.setattr(b, "BLOCKS_GATHERED", gathered)
        _, found = b.fit_forests(df.repartition(5), FEATURES, targets, settings, 100)
        for x, y in zip(plain, found, strict=True):
            assert len(x) == 5 and all(np.array_equal(getattr(x, k), getattr(y, k)) for k in ("feature", "cut", "gain", "leaf"))
    assert all(n <= max(1, (1 << level) // 2) for level, n in asked) and len(asked) <= 2 * 2 * 5 * 3
    assert len(gone) == 6 and placed[0] is None and placed[1] is not None
    assert not any(b.os.path.exists(folder) for folder in gone)


def test_rows_beyond_a_block_are_dealt_to_the_cores():
    million = 1_000_000
    assert [b.blocks_of(n, 12, 3, million) for n in (1, million, million + 1, 2_570_000, 15_400_000)] == [1, 1, 5, 6, 18]
    assert b.blocks_of(2_570_000, 12, 1, million) == 12 and b.blocks_of(300, 8, 3, 130) == 3


def test_a_level_follows_from_one_child_of_each_node():
    """Children of nodes that were split and that were not, and of empty ones."""
    r = np.random.default_rng(11)
    bins, g = r.integers(0, 16, (900, 3)).astype(np.uint8), np.rint(r.normal(size=900) * b.UNIT)
    h, node = np.rint(r.random(900) * b.UNIT) + 1, r.integers(0, 3, 900)
    before = b.sums(bins, node, g, h, 4, 16)
    found = {0: (1, 4, 1.0, 0, 0), 1: (0, b.NO_SPLIT, 0.0, 0, 0), 2: (2, 12, 1.0, 0, 0)}   # node 3 has no rows
    right = np.array([bins[i, 1] > 4 if n == 0 else n == 2 and bins[i, 2] > 12 for i, n in enumerate(node)])
    whole, nodes = b.sums(bins, 2 * node + right, g, h, 8, 16), b.smaller(before, found)
    assert nodes == [0, 5]
    assert np.array_equal(b.children(before, nodes, [whole[n] for n in nodes]), whole)
