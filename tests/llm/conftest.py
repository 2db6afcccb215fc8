import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, size long, fp string, label int"


def documents(spark, texts, ids=None, **columns):
    """A documents table with some extra columns whose names clash with inner ones."""
    n = len(texts)
    lang, source = columns.get("lang") or ["en", "de", None] * n, columns.get("source") or ["a", "b", None] * n
    rows = [(ids[i] if ids else i, t, lang[i], source[i], None, "x", None, 7, "f", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    """Empty, blank, long, tied, repeated and otherwise difficult texts."""
    r = random.Random(5)
    words = [f"w{r.randrange(60)}" for _ in range(3000)]
    plain = " ".join(words[:200])
    return [None, "", " ", "\n\t\x0b\x0c\r", "one", "two words", "a b c", "a b c d", plain, plain, plain.replace("w1 ", "w1  "),
            plain + " tail", plain.upper(), " ".join(words), "same " * 400, "x" * 5000, "é ß Σ İ 漢字 🙂   \x1c \x85 nbsp\xa0x",
            "line one\nline one\n\n \nline two\nline one", "# * $ % & | < >", "\x00 zero \x00 bytes", "a,b;c.d" * 30]


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, odd_texts()).cache()
