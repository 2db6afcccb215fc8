import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridcast.llm import packing as pk
from gridcast.llm.common import tokenizer_path
from tests.llm.conftest import documents, odd_texts

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = ["a<|endoftext|>b <|endoftext|>", "ΑΒΓ αβγ Привет 漢字かな 🙂 ١٢٣ Ⅷ ²½  x　y\xa0z\x85", "it's we'LL 'tis  two   spaces \t\n\n x", "naïve café ÀÉ ß",
       "͸̀​‍﻿", "x" * 9000, " " * 3000, "é" * 2000]


def one_by_one(lengths, size):
    """Best-two-fit on the pieces themselves, one sequence after the other."""
    left, out = sorted(lengths), []
    while left:
        mine, gap = [], size
        while fits := [x for x in left if x <= gap]:
            left.remove(fits[-1])
            mine.append(fits[-1])
            gap -= fits[-1]
        if gap:
            free = sorted([*left, mine[-1]])
            sums = [(free[i] + free[j], free[i], free[j]) for i in range(len(free)) for j in range(i) if free[i] + free[j] <= gap + mine[-1]]
            best = max(sums, default=(0,))
            if best[0] > mine[-1]:
                left = sorted([*left, mine.pop()])
                for x in best[1:]:
                    left.remove(x)
                    mine.append(x)
        out.append(sum(mine))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_plan_on_counts_packs_like_one_by_one(seed):
    r = random.Random(seed)
    size = r.choice([10, 37, 64])
    pool = [r.randrange(1, size + 1) for _ in range(r.randrange(1, 14))]
    lengths = [r.choice(pool) for _ in range(r.randrange(1, 140))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = pk.plan(counts, size)
    packed = [n for chosen, times in steps for n in chosen * times]
    assert sorted(packed) == sorted(lengths) and all(sum(c) <= size for c, _ in steps)
    assert [sum(c) for c, t in steps for _ in range(t)] == one_by_one(lengths, size)


def test_two_replace_the_smallest():
    assert pk.plan({7: 1, 2: 1, 6: 1, 5: 1}, 12)[0] == ([7, 5], 1)
    assert pk.plan({8: 1, 3: 2, 4: 1, 2: 1}, 14)[0] == ([8, 4, 2], 1)
    assert pk.plan({10: 1, 8: 1, 6: 1, 5: 1}, 20)[0] == ([10, 8], 1)
    assert pk.plan({10: 1, 9: 1, 6: 1, 4: 1}, 20)[0] == ([10, 6, 4], 1)


def test_plan_does_not_grow_with_the_documents():
    r = random.Random(1)
    few = {n: r.randrange(1, 100) for n in range(1, 1025)}
    assert len(pk.plan({n: c * 10 ** 9 for n, c in few.items()})) <= 4 * 1024


@pytest.mark.parametrize("text", [t for t in odd_texts() if t] + ODD)
def test_ids_are_the_library_s(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert pk.encoder(PATH)(text) == want


def test_long_texts_are_cut_between_pre_tokens(monkeypatch):
    r = random.Random(3)
    text = " ".join(r.choice(["word", "it's", "x  y", "漢字", "né", "a\n b", "<|endoftext|>", "..."]) for _ in range(4000))
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(pk, "LONG", 100)
    assert pk.encoder(PATH)(text) == want


def texts():
    r = random.Random(4)
    vocabulary = ["token", "sequence", "a", "of", "packing", "é", "x1", "\n"]
    return odd_texts() + ODD + [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 400))) for _ in range(60)] + ["the same text"] * 70


@pytest.mark.parametrize("size", [16, 1024])
def test_pieces_hold_every_document(spark, size):
    docs = documents(spark, texts()).repartition(7)
    rows = pk.pack(docs, PATH, size=size, with_ids=True).collect()
    whole = Tokenizer.from_file(PATH)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert sorted(by) == list(range(len(texts())))
    for i, t in enumerate(texts()):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        mine = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(-(-len(ids) // size)))
        assert [r.start for r in mine] == list(np.cumsum([0, *[r.length for r in mine][:-1]]))
        assert all(r.length == size for r in mine[1:]) and sum(r.length for r in mine) == len(ids)
        for r in mine:
            raw = struct.pack(f"<{r.length}I", *ids[r.start:r.start + r.length])
            assert (r.ids_crc32, bytes(r.ids)) == (zlib.crc32(raw), raw)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in bins.values():
        p.sort()
        assert [o for o, _ in p] == list(np.cumsum([0, *[n for _, n in p][:-1]])) and sum(n for _, n in p) <= size
    lengths = [r.length for r in rows]
    assert len(bins) == len(one_by_one(lengths, size)) <= 1.1 * -(-sum(lengths) // size) + 1


def test_whole_sequences(spark):
    packed = pk.pack(documents(spark, texts()), PATH, size=64, with_ids=True).cache()
    got = {r.sequence_id: r for r in pk.sequences(packed).collect()}
    for r in packed.collect():
        s = got[r.sequence_id]
        assert bytes(s.ids)[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids) and r.offset in s.offsets
    assert all(len(s.ids) == 4 * s.n_tokens for s in got.values())


def test_null_ids_and_empty_tables(spark):
    rows = pk.pack(documents(spark, ["a", None, "a"], [None, None, 1]), PATH).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows) == [0, 2, 4]
    assert pk.pack(documents(spark, []), PATH).collect() == []
    assert pk.pack(documents(spark, ["a"]).withColumn("rank", F.lit(1)), PATH).count() == 1
