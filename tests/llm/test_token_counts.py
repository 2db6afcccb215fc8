import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridcast.llm import token_counts as tc
from tests.llm.conftest import documents, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_matches_the_library_on_random_strings(library):
    r = random.Random(2)
    parts = [*"abcXYZ \n\t'`<|>0123éñßΣσİıＡ漢か🙂 \x1c\x85\x00.,!?", "́", "<|endoftext|>", "<|startoftext|>", "<|end",
             "'s", "'re", "'LL", "aaaa", "oooo", "ﬁ", "ΑΣ ", "ẞ", "  ", "<|endoftext|><|endoftext|>"]
    texts = ["".join(r.choices(parts, k=r.randrange(50))) for _ in range(4000)] + ["a" * 4000, "ab" * 3000] + odd_texts()
    got = tc.count_texts(tc.merger(PATH), pa.array(texts, pa.string()), {})
    assert got.tolist() == expected(library, texts)


def test_every_row_through_spark(spark, odd, library):
    got = {r.doc_id: r for r in tc.token_counts(odd, PATH).collect()}
    for i, (t, n) in enumerate(zip(odd_texts(), expected(library, odd_texts()), strict=True)):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)


def test_empty_repeated_and_null(spark, odd):
    assert tc.token_counts(odd.filter("false"), PATH).count() == 0
    got = tc.token_counts(documents(spark, ["a b", "a b", None], ids=[1, 1, None]), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 0), (1, 2), (1, 2)]


def test_kept_pieces_do_not_change_counts():
    m, kept = tc.merger(PATH), {}
    a = pa.array(["some text here", "and more", None])
    first = tc.count_texts(m, a, kept).tolist()
    assert kept and tc.count_texts(m, a, kept).tolist() == first
    assert tc.count_texts(m, a.slice(1), kept).tolist() == first[1:]


def test_long_words_are_merged_by_rank(library, monkeypatch):
    r, m = random.Random(4), tc.merger(PATH)
    texts = ["".join(r.choices(letters, k=r.randrange(200, 3000)))
             for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "a", "etaoin", "éñ漢かa", "oo l") for _ in range(20)]
    assert tc.count_texts(m, pa.array(texts), {}).tolist() == expected(library, texts)
    # the same for words of any length
    monkeypatch.setattr(tc, "LONG_WORD", 1)
    texts = ["".join(r.choices("abcXYZ etaoin,.é\n", k=r.randrange(80))) for _ in range(2000)] + odd_texts()
    assert tc.count_texts(m, pa.array(texts, pa.string()), {}).tolist() == expected(library, texts)


def test_a_word_of_400000_letters(library):
    text = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=400_000))
    assert tc.count_texts(tc.merger(PATH), pa.array([text]), {}).tolist() == expected(library, [text])
