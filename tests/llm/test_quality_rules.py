import random

from gridcast.llm import quality_rules as q
from tests.llm import brute
from tests.llm.conftest import documents, odd_texts

LABELS = "doc_id long, quality int, toxic int"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_base_statistics_match_brute_force(spark, odd):
    got, rules = q.quality_rules(odd, spark.createDataFrame([], LABELS))
    assert rules.rules == []
    for i, r in rows_of(got).items():
        t = odd_texts()[i]
        assert tuple(r[c] for c in (*q.BASE, "base_failed")) == brute.base_quality(t), repr(t)
        assert r.kept == (not r.base_failed)


def test_empty_tables(spark, odd):
    empty = odd.filter("false")
    got, rules = q.quality_rules(empty, spark.createDataFrame([(1, 0, 1)], LABELS))
    assert got.count() == 0 and rules.rules == []


def test_learns_planted_rules_and_keeps_clean(spark):
    r = random.Random(1)
    texts, labels = [], []
    for i in range(900):
        w = [f"w{chr(97 + r.randrange(20))}ord{r.randrange(300)}" for _ in range(r.randrange(60, 160))]
        bad = i % 3 == 0
        if i % 6 == 0:
            w = [x + "#" * r.randrange(1, 3) for x in w]
        elif bad:
            w[r.randrange(len(w))] = "horrible"
        texts.append(" ".join(w))
        labels.append((i, 0 if i % 6 == 0 else 1, int(bad and i % 6 != 0)))
    docs = documents(spark, texts)
    # null ids, null labels and contradicting repeats do no harm
    extra = [(None, 0, 1), (5, None, None), (10 ** 9, 1, 0), (0, 0, 0)]
    got, rules = q.quality_rules(docs, spark.createDataFrame(labels + extra, LABELS))
    assert rules.rules
    got = rows_of(got)
    wrong = [i for i in range(900) if got[i].kept != (i % 3 != 0)]
    assert len(wrong) < 9, (wrong, rules)


def test_repeated_rows_and_null_ids(spark):
    t = " ".join(f"a{i}" for i in range(60))
    docs = documents(spark, [t, t, t + " b", None], ids=[1, 1, None, None])
    got, _ = q.quality_rules(docs, spark.createDataFrame([], LABELS))
    assert sorted((r.doc_id or -1, r.n_words, r.kept) for r in got.collect()) == [(-1, 0, False), (-1, 61, True), (1, 60, True), (1, 60, True)]


def test_plan_is_native(spark, odd):
    got, _ = q.quality_rules(odd, spark.createDataFrame([(8, 0, 0), (9, 1, 0)], LABELS))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
