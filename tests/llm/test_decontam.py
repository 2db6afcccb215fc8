import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gridcast.llm import decontam
from tests.llm import brute
from tests.llm.conftest import documents, odd_texts

ITEMS = "item_id long, text string, h string, need int"


def found(docs, items, **kw):
    got = decontam.contamination(docs, items, **kw)
    return sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
                  for r in got.collect())


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, "h", 1) for i, t in enumerate(texts)], ITEMS)


def test_matches_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(4)] + ["Same", "É", "é"]  # few words, so that much is shared
    items = [" ".join(r.choices(vocab, k=n)) for n in (1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 13, 14, 20, 40)] + [None, "", "...", "w1 w1"]
    texts = [" ".join(r.choices(vocab + [f"z{i}" for i in range(3)], k=r.randrange(0, 60))) for _ in range(60)]
    for it in items[7:14]:
        texts += ["x, " + it.upper().replace("É", "é") + "! y", "y " * 300 + it, it[2:]]
    texts += odd_texts()
    docs, items_df = documents(spark, texts), items_of(spark, items)
    assert found(docs, items_df) == sorted(brute.contamination(list(enumerate(texts)), list(enumerate(items))))


def test_only_whole_windows_hit(spark):
    w = [f"a{i}" for i in range(40)]
    docs = documents(spark, [" ".join(w[:n]) for n in (12, 13, 14)] + [" ".join(w[:6] + ["q"] + w[6:13])])
    assert [x[2] for x in found(docs, items_of(spark, [" ".join(w)]))] == [0, 13, 14, 0]


def test_empty_null_and_repeated_rows(spark, odd):
    assert found(odd.filter("false"), items_of(spark, ["a b"])) == []
    assert all(x[2:4] == (0, 0) for x in found(odd, items_of(spark, [])))
    t = " ".join(f"a{i}" for i in range(20))
    docs = documents(spark, [t, t, "other", t], ids=[1, 1, 1, None])
    got = decontam.contamination(docs, spark.createDataFrame([(None, t, "h", 1), (3, t, "h", 1), (3, t, "h", 1)], ITEMS))
    assert sorted((r.doc_id or -1, r.n_hit, r.n_items) for r in got.collect()) == [(-1, 20, 1), (1, 0, 0), (1, 20, 1), (1, 20, 1)]


@pytest.mark.parametrize("c", decontam.classes_for(13))
def test_every_span_of_guaranteed_length_shares_a_fingerprint(spark, c):
    assert c.k + c.w - 1 == c.least
    r = random.Random(c.least)
    a = [r.randrange(3) for _ in range(200)]
    b = [r.randrange(3) for _ in range(20)] + a[40:40 + c.least] + [r.randrange(3) for _ in range(20)]
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    kept = [decontam._fingerprints(F.col(x), decontam._grams(F.col(x), c.k), c, lambda v: F.lit(True)).alias(f"k{x}") for x in "ab"]
    row = df.select("a", "b", *kept).first()
    left = {f.fp for f in row.ka if 40 <= f.p <= 40 + c.least - c.k}
    right = {f.fp for f in row.kb if 20 <= f.p <= 20 + c.least - c.k}
    assert left & right


def test_plan_is_native(spark, odd):
    plan = decontam.contamination(odd, items_of(spark, ["a b c"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
