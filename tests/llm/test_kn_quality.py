import math
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import char_model
from gridcast.llm import kn_quality as kn
from tests.llm.conftest import documents, odd_texts

LABELS = "doc_id long, quality int, toxic int, lang string"


def brute_model(texts):
    """Interpolated modified Kneser-Ney by dictionaries; probability of a 4-gram."""
    counts = {4: Counter()}
    for t in texts:
        c = [0, 0, 0, *kn.classes_of(t).tolist()]
        counts[4].update(tuple(c[i:i + 4]) for i in range(len(c) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {k: kn._discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}

    def p(g):
        k = len(g)
        below = 1 / kn.CLASSES if k == 1 else p(g[1:])
        rest = {h: n for h, n in counts[k].items() if h[:-1] == g[:-1]}
        if not rest:
            return below
        total = sum(rest.values())
        d = lambda n: off[k][min(n, 3) - 1]
        return (rest[g] - d(rest[g]) if g in rest else 0) / total + sum(d(n) for n in rest.values()) / total * below
    return p


def corpus(seed, n):
    r = random.Random(seed)
    syll = ["the", "an", "in", "er", "on", "re", "ti", "sh", "ou", "ha"]
    return [" ".join("".join(r.choices(syll, k=r.randrange(1, 4))) for _ in range(r.randrange(20, 60))) + "." for _ in range(n)]


def test_model_equals_brute_force(spark):
    texts = corpus(1, 12) + ["É ñ 12 a@b.c JUNK!!", "", None]
    logp = kn.train(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3))
    p, r = brute_model([t for t in texts if t]), random.Random(4)
    grams = [tuple(r.randrange(kn.CLASSES) for _ in range(4)) for _ in range(60)]
    for t in texts[:3]:
        c = [0, 0, 0, *kn.classes_of(t).tolist()]
        grams += [tuple(c[i:i + 4]) for i in range(0, len(c) - 3, 7)]
    for g in grams:
        at = ((g[0] * kn.CLASSES + g[1]) * kn.CLASSES + g[2]) * kn.CLASSES + g[3]
        assert logp[at] == pytest.approx(math.log(p(g)), abs=1e-5)
    one = np.exp(logp.reshape(-1, kn.CLASSES).astype(np.float64)).sum(axis=1)
    assert np.allclose(one, 1, atol=1e-4)


def test_bad_texts_go_and_clean_ones_stay(spark):
    """Held-out accuracy on documents without labels."""
    good = corpus(2, 500)
    toxic = [t.replace(" ", " pqvzwk ", 1).replace(". ", " ").replace(" er", " jxqmub er", 1) for t in corpus(3, 60)]
    junk = ["".join(random.Random(i).choices("#%$&zqxj ", k=300)) for i in range(40)]
    texts = good + toxic + junk
    labels = [(i, 1, 0, "x") for i in range(0, 400)] + [(500 + i, 1, 1, "x") for i in range(20)] + [(560 + i, 0, 0, "x") for i in range(10)]
    labels += [(None, 1, 0, "x"), (450, None, None, "x"), (451, 1, 0, "x"), (451, 0, 0, "x")]
    got = {r.doc_id: r for r in kn.classify(documents(spark, texts, lang=["en"] * len(texts)), spark.createDataFrame(labels, LABELS)).collect()}
    assert sum(not got[i].kept for i in range(500)) <= 10
    assert sum(got[i].kept for i in range(500, 600)) <= 3


def test_defined_cases(spark, odd):
    empty = spark.createDataFrame([], LABELS)
    rows = kn.classify(odd, empty).collect()
    assert len(rows) == len(odd_texts()) and all(r.kept and r.perplexity is None for r in rows)
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(8, 14)], LABELS)
    rows = {r.doc_id: r for r in kn.classify(odd, labels).collect()}
    for i, t in enumerate(odd_texts()):
        assert (rows[i].perplexity is None) == (not (t or "").strip(" \t\n\x0b\x0c\r\xa0"))
    assert rows[8].perplexity == rows[9].perplexity
    assert kn.classify(odd.filter("false"), labels).count() == 0


def test_pieces_of_long_texts(spark):
    r = np.random.default_rng(1)
    logp = np.log(r.dirichlet(np.ones(kn.CLASSES), kn.CLASSES ** 3).ravel()).astype(np.float32)
    t = " ".join(corpus(5, 30))
    whole = kn.score(t, logp)
    assert "".join(kn.pieces(t, 100)) == t and all(len(p) <= 100 for p in kn.pieces(t, 100))
    old, kn.pieces.__defaults__ = kn.pieces.__defaults__, (200,)
    try:
        parts = kn.score(t, logp)
    finally:
        kn.pieces.__defaults__ = old
    assert parts[0] == pytest.approx(whole[0], rel=0.05)


def test_sharded_model_equals_brute_force_for_all_characters(spark):
    """Real characters: Cyrillic, CJK and digits are symbols of their own, none of them in classes."""
    texts = corpus(1, 8) + ["слово слева 1diot 漢字仮名 🙂", "снова словами a@b.c", "", None]
    rows = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "fold int, text string").repartition(3)
    model = char_model.train(char_model.counts_of_texts(rows, kn.symbols_of), 3, kn._discounts)
    for m in (0, 1):
        counts = {4: Counter()}
        for i, t in enumerate(texts):
            if i % 3 != m:
                for s in kn.symbols_of(t or ""):
                    c = [32, 32, 32, *s.tolist()]
                    counts[4].update(tuple(c[j:j + 4]) for j in range(len(c) - 3))
        for k in (3, 2, 1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        off = {k: kn._discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}

        def p(g, counts=counts, off=off):
            k = len(g)
            below = 1 / (len(counts[1]) + 1) if k == 1 else p(g[1:], counts, off)
            rest = [n for h, n in counts[k].items() if h[:-1] == g[:-1]]
            if not rest:
                return below
            n = counts[k].get(g, 0)
            freed = sum(off[k][min(x, 3) - 1] for x in rest)
            return ((n - off[k][min(n, 3) - 1]) if n else 0) / sum(rest) + freed / sum(rest) * below
        grams = {tuple(map(ord, g)) for g in ("слов", "снов", "漢字仮名", "1dio", "the ", "zzzz", "th漢q", "\U0001f642\U0001f642 a")}
        asked = spark.createDataFrame([(m, (g[0] << 42) | (g[1] << 21) | g[2], g[3]) for g in grams], "m int, ctx long, c int")
        got = {(r.ctx, r.c): r.logp for r in char_model.log_probabilities(asked, model).collect()}
        for g in grams:
            assert got[(g[0] << 42) | (g[1] << 21) | g[2], g[3]] == pytest.approx(math.log(p(g)), abs=1e-9)


def test_foreign_letters_and_words_with_digits_are_told_apart(spark):
    """Letters that fell into one class, and junk that was one symbol like a number."""
    r = random.Random(6)
    word = lambda s: "".join(r.choices(s, k=5))
    good = [" ".join(word("абвгд") for _ in range(40)) + " 2024" for _ in range(60)]
    swap = {c: next(x for x in map(chr, range(0x4E00, 0x9FFF)) if kn.class_table()[ord(x)] == kn.class_table()[ord(c)]) for c in "абвгд"}
    bad = [good[0].translate(str.maketrans(swap)), good[1] + " " + " ".join("".join(r.choices("0123456789abcdef", k=40)) for _ in range(20))]
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(50)], LABELS)
    got = {r.doc_id: r for r in kn.classify(documents(spark, good + bad, lang=["ru"] * 62), labels).collect()}
    assert sum(got[i].kept for i in range(60)) >= 55
    assert not got[60].kept and not got[61].kept


def test_small_language_is_judged_by_its_own_level(spark):
    """Few trusted documents of a language that is harder than the many of another."""
    r = random.Random(8)
    easy = corpus(7, 300)
    hard = [" ".join("".join(r.choices("абвгдежзиклмнопрст", k=6)) for _ in range(40)) for _ in range(40)]
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(300)] + [(300 + i, 1, 0, "x") for i in range(30)], LABELS)
    rows = kn.classify(documents(spark, easy + hard, lang=["en"] * 300 + ["ru"] * 40), labels).collect()
    got = {x.doc_id: x for x in rows}
    assert sum(got[i].kept for i in range(300, 340)) >= 37
    limit = {x.lang: x.perplexity_limit for x in rows}
    assert limit["ru"] > 1.5 * limit["en"]
    assert limit["en"] < max(got[i].perplexity for i in range(300))


def test_verdicts_from_end_to_end(spark):
    """Perplexities, limits and verdicts of a table against dictionaries and sorted lists."""
    texts = corpus(11, 60) + ["zq jx vk " * 30, None, "", "слово " * 9, *corpus(12, 3)]
    texts += [texts[0], texts[5]]
    trusted = set(range(50))
    docs = documents(spark, texts, lang=["en"] * len(texts)).withColumn("a.b", F.lit(1)).repartition(5)
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in trusted], LABELS)
    got = {r.doc_id: r for r in kn.classify(docs, labels, carry=("doc_id", "text", "a.b", "size")).collect()}
    fold = {r.doc_id: r.m for r in docs.select("doc_id", F.pmod(F.xxhash64("text", F.lit("fold")), F.lit(kn.HELD_PART)).alias("m")).collect()}
    perplexity = {}
    for f in range(kn.HELD_PART):
        counts = {4: Counter()}
        for i in trusted:
            if fold[i] != f:
                for s in kn.symbols_of(texts[i]):
                    c = [32, 32, 32, *s.tolist()]
                    counts[4].update(tuple(c[j:j + 4]) for j in range(len(c) - 3))
        for k in (3, 2, 1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        off = {k: kn._discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
        after = {k: {} for k in counts}
        for k, c in counts.items():
            for g, n in c.items():
                after[k].setdefault(g[:-1], []).append(n)

        @lru_cache(maxsize=None)
        def p(g, counts=counts, off=off, after=after):
            k = len(g)
            below = 1 / (len(counts[1]) + 1) if k == 1 else p(g[1:])
            rest = after[k].get(g[:-1])
            if not rest:
                return below
            n = counts[k].get(g, 0)
            return ((n - off[k][min(n, 3) - 1]) if n else 0) / sum(rest) + sum(off[k][min(x, 3) - 1] for x in rest) / sum(rest) * below
        for i, t in enumerate(texts):
            if fold[i] == f and (t or "").strip():
                c = [32, 32, 32, *[x for s in kn.symbols_of(t) for x in s.tolist()]]
                perplexity[i] = math.exp(-sum(math.log(p(tuple(c[j:j + 4]))) for j in range(len(c) - 3)) / (len(c) - 3))
    for i, t in enumerate(texts):
        r = got[i]
        assert r.doc["text"] == t and r.doc["a.b"] == 1 and r.doc["doc_id"] == i and r.doc["size"] == 7
        if i not in perplexity:
            assert r.perplexity is None and r.kept
            continue
        assert r.perplexity == pytest.approx(perplexity[i], rel=1e-5)
        above = r.perplexity > r.perplexity_limit or (r.hard_word is not None and r.hard_word > r.hard_word_limit)
        assert r.kept == (not above)
    assert not got[60].kept and not got[63].kept and got[0].perplexity == got[67].perplexity
    own = sorted(math.log(perplexity[i]) for i in trusted)
    assert own[len(own) // 2] < math.log(got[0].perplexity_limit)


def test_texts_are_not_moved_again(spark):
    """Training, scoring and verdicts read the bucketed texts without a shuffle of them."""
    texts = corpus(3, 30)
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(20)], LABELS)
    out = kn.classify(documents(spark, texts, lang=["en"] * 30), labels, carry=("text",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange")[1:]:
        assert "text#" not in part.split("\n")[0]
