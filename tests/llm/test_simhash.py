import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import simhash as sh
from tests.llm import brute
from tests.llm.conftest import documents, odd_texts


def near_texts():
    r = random.Random(8)
    texts = []
    for _ in range(12):
        w = [f"w{r.randrange(10 ** 6)}" for _ in range(r.randrange(600, 900))]  # so long that one edit turns few bits
        for _ in range(r.randrange(2, 8)):
            texts.append(" ".join(w))
            w[r.randrange(len(w))] = "edit"
    return texts + odd_texts()


def test_fingerprints_and_components_match_brute_force(spark):
    texts = near_texts()
    got = {r.doc_id: r for r in sh.simhash_components(documents(spark, texts)).withColumn("hex", sh.hex_of(F.col("fp"))).collect()}
    fps = [brute.simhash(t) for t in texts]
    want = brute.components(list(range(len(texts))), fps)
    for i in range(len(texts)):
        assert (got[i].hex, got[i].component_id) == (f"{fps[i]:016x}", want[i])
    assert len(set(want)) < len(texts) / 2


def clusters(r, n, spread):
    out = set()
    for _ in range(n):
        x = r.getrandbits(64)
        for _ in range(40):
            y = x
            for _ in range(r.randrange(spread)):
                y ^= 1 << r.randrange(64)
            out.add(y)
    return sorted(out)


@pytest.mark.parametrize("spread", [2, 6, 12])
def test_forest_finds_all_links(spread):
    r = random.Random(spread)
    fps = np.array(clusters(r, 8, spread), np.uint64)
    shard = np.sort(np.array([r.randrange(3) for _ in fps]))
    got = sh.forest_classes(fps, shard, 4)
    for s in range(3):
        at = np.flatnonzero(shard == s)
        assert brute.components(at.tolist(), [int(x) for x in fps[at]]) == got[at].tolist()


@pytest.mark.parametrize("agree, cap", [(1, 8192), (1, 7), (2, 20), (3, 8192)])
def test_links_whatever_the_shards(spark, agree, cap):
    """Every table size and hot shards split into pieces give the same components."""
    fps = clusters(random.Random(agree), 5, 9)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    stars = {r.u: r.root for r in sh.close_links(sh.fingerprint_links(nodes, shard_cap=cap, agree=agree)).collect()}
    got = [stars.get(x, x) for x in signed]
    want = brute.components(list(range(len(fps))), fps)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_blocks_cover_all_placements():
    for agree in range(1, 5):
        masks = [m & (1 << 64) - 1 for m in sh.masks_of(agree)]
        r = random.Random(agree)
        for _ in range(300):
            diff = sum(1 << b for b in r.sample(range(64), 4))
            assert any(m & diff == 0 for m in masks)


def test_long_chain_closes(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2000, 2001)], "u long, v long")
    got = {r.u: r.root for r in sh.close_links(links).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 2001: 2000}


def test_empty_null_and_repeated(spark, odd):
    assert sh.simhash_components(odd.filter("false")).count() == 0
    got = sh.simhash_components(documents(spark, [None, "", "a b c d e", "a b c d e", "a b c d e"], ids=[None, 4, 9, 9, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 4), (-1, 9), (4, 4), (9, 9), (9, 9)]
    got = sh.simhash_components(documents(spark, ["alone here now"], ids=[None])).collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(None, None)]


@pytest.mark.parametrize("hot", [1, 4, 10 ** 6])
def test_look_up_is_the_same_for_hot_keys(spark, monkeypatch, hot):
    """Keys over the bound go by broadcast, the others by the plain join; together each row comes once."""
    monkeypatch.setattr(sh, "HOT", hot)
    rows = spark.createDataFrame([(i, 0 if i < 40 else i % 7) for i in range(100)], "i long, k long")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("least"))
    got = sh._looked_up(rows, table, "k", 100).collect()
    least = {}
    for i in range(100):
        least.setdefault(0 if i < 40 else i % 7, i)
    assert sorted((r.i, r.least) for r in got) == [(i, least[0 if i < 40 else i % 7]) for i in range(100)]


def test_null_ids_in_a_component(spark):
    """A component's id is its least id that is not null; without any it is null."""
    text = "one two three four five six"
    got = sh.simhash_components(documents(spark, [text, text, None, "a b c d e f g"], ids=[None, 7, None, 3])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got if r.component_id is not None) == [(False, 3, 3), (False, 7, 7), (True, 0, 7)]
    assert sum(r.component_id is None for r in got) == 1
