import random
import re

from gridcast.llm import line_dedup
from tests.llm import brute
from tests.llm.conftest import documents, odd_texts


def one_apart(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows, near=3):
    """Kept line numbers of (id, text) rows that are in order of place."""
    seen, out = [], []
    for _, text in rows:
        keep = []
        for j, line in enumerate((text or "").split("\n")):
            w = brute.WORD.findall(line)
            if w:
                if not any(w == v or (min(len(w), len(v)) >= near and one_apart(w, v)) for v in seen):
                    keep.append(j)
                seen.append(w)
        out.append(keep)
    return out


def random_texts(seed):
    r = random.Random(seed)
    base = [[f"w{r.randrange(12)}" for _ in range(r.randrange(2, 14))] for _ in range(24)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(r.randrange(1, 6)):
            w = list(r.choice(base))
            for _ in range(r.randrange(3)):
                k, i = r.randrange(3), r.randrange(len(w))
                if k == 0:
                    w[i] = f"z{r.randrange(3)}"
                elif k == 1:
                    w.insert(i, "y")
                elif len(w) > 2:
                    del w[i]
            lines.append(r.choice([" ", "  ", "\t"]).join(w))
        texts.append("\n".join(lines))
    return texts + odd_texts()


def test_matches_brute_force(spark):
    texts = random_texts(1)
    got = {r.doc_id: r for r in line_dedup.kept_lines(documents(spark, texts)).collect()}
    want = expected(list(enumerate(texts)))
    assert sum(r.n_near for r in got.values()) > 20
    for i, keep in enumerate(want):
        assert got[i].kept == keep
        assert got[i].n_lines == got[i].n_equal + got[i].n_near + len(keep)


def test_texts_without_the_lines(spark):
    texts = random_texts(2)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, texts)).collect()}
    for i, (t, keep) in enumerate(zip(texts, expected(list(enumerate(texts))), strict=True)):
        want = None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j in keep or not re.search(r"[^\x20\x09-\x0D]", x))
        assert got[i] == want


def test_short_lines_have_near_duplicates(spark):
    texts = ["Posted by Anna on 3 May 2020\nPage 3 of 17\nsee also", "Posted by Anna on 4 May 2020\nPage 4 of 17\nsee here", "Page of 17", "one two three four\nfour three two one"]
    got = {r.doc_id: r.kept for r in line_dedup.kept_lines(documents(spark, texts)).collect()}
    assert got == {0: [0, 1, 2], 1: [2], 2: [], 3: [0, 1]}


def test_very_common_line_and_hot_key(spark):
    common = "this very common line stands in every one of them"
    texts = [f"{common}\nnumber {i} of a form with nine words here" for i in range(200)]
    got = {r.doc_id: r.kept for r in line_dedup.kept_lines(documents(spark, texts)).collect()}
    assert got[0] == [0, 1] and all(got[i] == [] for i in range(1, 200))


def test_empty_null_and_repeated(spark, odd):
    assert line_dedup.kept_lines(odd.filter("false")).count() == 0
    docs = documents(spark, ["a b\na b", "a b\na b", None, "a b", "c d"], ids=[1, 1, 2, None, None])
    got = sorted((r.doc_id or 9, r.kept) for r in line_dedup.kept_lines(docs).collect())
    assert got == [(1, [0]), (1, [0]), (2, []), (9, []), (9, [0])]


def test_one_word_apart():
    assert line_dedup.words_within(list("abc"), list("abc")) and line_dedup.words_within(list("abc"), list("axc"))
    assert line_dedup.words_within(list("abc"), list("ac")) and line_dedup.words_within([], ["a"])
    assert not line_dedup.words_within(list("abc"), list("bca")) and not line_dedup.words_within(list("ab"), list("abcd"))
