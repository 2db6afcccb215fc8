import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridcast.llm import manifest as m
from tests.llm.conftest import DOCS, documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, add=0):
    return h(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"] if r["n_chars"] is None else r["n_chars"] + add, r["text"])))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, i):
    for level in levels[:-1]:
        run = level[i // 2 * 2:i // 2 * 2 + 2]
        yield i % 2, run[1 - i % 2] if len(run) == 2 else ""
        i //= 2


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault((r["lang"] is not None, (r["lang"] or "").encode()), []).append(r)
    trees = {g: sorted(rs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g, rs in by.items()}
    levels = {g: levels_of([leaf(r) for r in rs]) for g, rs in trees.items()}
    langs = sorted(trees)
    top = levels_of([levels[g][-1][0] for g in langs])
    for k, g in enumerate(langs):
        for i, r in enumerate(trees[g]):
            path = [*siblings(levels[g], i), *siblings(top, k)]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            acc = leaf(r, 1 if bad else 0)
            for odd, sib in path:
                acc = h(sib, acc) if odd else h(acc, sib)
            yield (r["doc_id"], leaf(r), levels[g][-1][0], top[-1][0], h(*[s for _, s in path]), acc, acc == top[-1][0])


def table(spark, langs, n, seed=1, null_ids=False):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((None if null_ids and i % 5 == 0 else i // 2 if i % 9 == 0 else i, r.choice([None, "", "text é 漢", "x" * 5000]), r.choice(langs),
                     r.choice([None, "s", "ü"]), r.choice([None, 0, 2 ** 63 - 2, i]), "x", None, 7, "f", 1))
    return spark.createDataFrame(rows + rows[:3], DOCS)


def key(t):
    return tuple(map(str, t))


@pytest.mark.parametrize("langs, n, every", [(["en"], 1, 4), (["en"], 2, 1), (["en", None, "de", ""], 90, 2), (["en", "de"], 300, 4), (["x"], 33, 3),
                                             ([f"l{i}" for i in range(40)], 60, 2), (["en", "rare"] + ["en"] * 60, 140, 5)])
def test_verify_matches_brute_force(spark, langs, n, every):
    docs = table(spark, langs, n, null_ids=n > 100)
    got = m.verify(docs, every).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute([r.asDict() for r in docs.collect()])))
    changed = [r.verified for r in got if r.folded_root != r.root]
    assert not any(changed) and (n < 30 or changed)


def test_only_every_few_levels_are_written(spark):
    found = m.manifest(table(spark, ["en"], 300), every=4)
    assert [t.count() for t in found.trees.levels] == [303, 19, 2, 1]


def test_proofs_of_some_documents(spark):
    docs = table(spark, ["en", "de"], 120)
    found = m.manifest(docs, every=2)
    want = spark.createDataFrame([(7,), (64,), (1000,)], "doc_id long")
    some = found.proofs(want)
    whole = {(r.doc_id, r.leaf, str(r.path)) for r in found.proofs().collect() if r.doc_id in (7, 64)}
    assert {(r.doc_id, r.leaf, str(r.path)) for r in some.collect()} == whole and whole
    assert {r.f for r in some.select(m.fold(F.col("leaf"), F.col("path")).alias("f")).collect()} == {found.root}


def test_odd_and_empty_tables(spark, odd):
    assert sorted(map(key, m.verify(odd).collect())) == sorted(map(key, brute([r.asDict() for r in odd.collect()])))
    assert m.verify(documents(spark, [])).collect() == []
