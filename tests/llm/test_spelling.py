import collections
import random
import re
import zlib

import pytest

from gridcast.llm import spelling as sp
from tests.llm.brute import UP
from tests.llm.conftest import documents


def counts(texts, ids, delete_every=None, least=5, often=3):
    n = collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if delete_every and h % delete_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=2):
    forms, out = {}, []
    of = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    for w, others in of.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(of[w]), n[forms[w]] if forms[w] else None))
    return sorted(out)


def vocabulary(seed, alphabet):
    r = random.Random(seed)
    words = {"".join(r.choice(alphabet) for _ in range(r.randrange(3, 9))) for _ in range(60)}
    words |= {"template" * 4 + "".join(r.choice("abcd") for _ in range(4)) for _ in range(40)}
    words |= {"x" * k for k in range(4, 12)}
    for w in sorted(words):
        i = r.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + r.choice(alphabet) + w[i + 1:], w[:i] + r.choice(alphabet) + w[i:]}
    return sorted(words)


def texts_of(seed, alphabet="abé"):
    r = random.Random(seed)
    words = vocabulary(seed, alphabet)
    pool = [w for w in words for _ in range(r.choice([1, 3, 4, 9, 30]))]
    r.shuffle(pool)
    return [r.choice([" ", "-", "1", "\n", "漢"]).join(pool[i:i + 40]) for i in range(0, len(pool), 40)]


@pytest.mark.parametrize("seed, depth, most", [(1, 2, 256), (2, 2, 2), (3, 0, 1), (4, 3, 5)])
def test_words_match_brute_force(spark, seed, depth, most):
    """Whatever the depth and the size of a group, no near word is lost."""
    texts = texts_of(seed)
    got = sp.spelling_variants(documents(spark, texts), delete_every=7, depth=depth, most=most).collect()
    want = brute(counts(texts, range(len(texts)), 7))
    assert sorted(map(tuple, got)) == want
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want)


def test_short_words_and_long_ones(spark):
    r = random.Random(9)
    words = ["a", "b", "ab", "ba", "abc", "", "long" * 300, "long" * 300 + "x", "lonG" * 150 + "y" + "long" * 150]
    texts = [" ".join(r.choice(words) for _ in range(50)) for _ in range(9)]
    got = sp.spelling_variants(documents(spark, texts), min_length=1, min_count=1, most=2).collect()
    assert sorted(map(tuple, got)) == brute(counts(texts, range(9), None, 1, 1))


def test_ties_take_the_smallest_form(spark):
    texts = ["words " * 3 + "wordz " * 3 + "wordy " * 9 + "wordx " * 9 + "wordé " * 9]
    got = {r.word: (r.form, r.n_near, r.form_n) for r in sp.spelling_variants(documents(spark, texts)).collect()}
    assert got["words"] == ("wordx", 4, 9) and got["wordx"] == (None, 4, None)


def test_odd_texts_and_empty_tables(spark):
    texts = [None, "", "Ünder ünder ünder UNDER", "under under under under", "x" * 9000 + " ×××÷÷ ×××÷÷ ×××÷÷", "ÀBİcde"]
    ids = [None, 1, None, 2, 2, 3]
    got = sp.spelling_variants(documents(spark, texts, ids), delete_every=97).collect()
    assert sorted(map(tuple, got)) == brute(counts(texts, ids, 97))
    assert sp.spelling_variants(documents(spark, []), delete_every=97).collect() == []


def test_templates_do_not_meet_in_all_pairs(spark):
    """Words that share all but their ends get keys of their own."""
    words = [f"{'same' * 6}{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    rows = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = sp.near_words(rows, most=16)
    assert pairs.count() == 512 * 21 // 2
