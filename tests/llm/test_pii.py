import random

from gridcast.llm import pii
from tests.llm import brute
from tests.llm.conftest import documents, odd_texts


def spans_of(spark, texts):
    got, model = pii.personal_data(documents(spark, texts))
    return {r.doc_id: r for r in got.collect()}, model


def named(spans):
    return [((*pii.KINDS, "other")[s.k], s.start, s.end) for s in spans]


def test_base_spans_match_brute_force(spark):
    r = random.Random(9)
    parts = [*"0123456789.+-@ ()%_aZé🙂\n", "1.2.3.4", "255.255.255.255", "256.1.1.1", "4111 1111 1111 1111", "5500-0000-0000-0004",
             "+1 (555) 555-0100", "a@b.c", "a.b@c-d.e.f", "007.08.1.0", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "4111111111111111", "000.0.0.0"]
    texts = ["".join(r.choices(parts, k=r.randrange(40))) for _ in range(1500)]
    texts += odd_texts() + ["1 2 3 " * 8000, "9" * 30000, "a" * 30000 + "@", "+1" + " " * 20000, "1.2.3.4 " * 1000]
    got, _ = spans_of(spark, texts)
    for i, t in enumerate(texts):
        assert named(got[i].base) == brute.pii(t), repr(t[:80] if t else t)
        assert set(got[i].base) <= set(got[i].spans)


def test_method_adds_personal_spans_and_leaves_plain_numbers(spark):
    r = random.Random(2)
    secret = lambda: "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=15)) + "7"
    texts = []
    for i in range(240):
        texts.append((f"the key {secret()} here", f"a password=a{r.randrange(10 ** 9, 10 ** 10)}ff now", f"mail me at x{i}@mail.example.com today",
                      f"Licensed under version {r.randrange(9)}.0.\nsee page {i} for more")[i % 4])
    got, model = spans_of(spark, texts)
    assert model is not None
    for i, t in enumerate(texts):
        other = [t[s.start:s.end] for s in got[i].spans if s.k == 4]
        if i % 4 == 0:
            assert other == [t.split()[2]]
        elif i % 4 == 1:
            assert other == [t.split()[1]]
        else:
            assert other == []


def test_odd_empty_and_repeated(spark, odd):
    assert pii.personal_data(odd.filter("false"))[0].count() == 0
    got, model = pii.personal_data(documents(spark, [None, "", "x", "x"], ids=[1, None, 2, 2]))
    assert model is None and [len(r.spans) for r in got.collect()] == [0, 0, 0, 0]


def test_text_form(spark):
    got, _ = pii.personal_data(documents(spark, ["🙂 a@b.cd and 1.2.3.4"]))
    assert got.select(pii.span_text(got.base)).first()[0] == "email:2:8,ip:13:20"


def test_reliabilities_are_learned():
    """A labeler that contradicts three agreeing ones is found out."""
    counts = [("pppn", 1, 400), ("nnnp", 0, 400), ("ppp-", 1, 50), ("nnn-", 0, 50)]
    model = pii.fit(counts)
    assert min(min(x) for x in model.reliability[:3]) > 0.9 and max(model.reliability[3]) < 0.2


def test_plan_is_native(spark, odd):
    plan = pii.personal_data(odd)[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labelers_propose_spans_of_several_words(spark):
    """Recall and precision by kind on planted formats, names, streets and secrets."""
    r = random.Random(5)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    make = [
        lambda: f"DE{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)} {digits(2)}",
        lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        lambda: "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=16)),
        lambda: f"{r.choice(['Mr', 'Dr.', 'Frau', 'Señora'])} {r.choice(['Miller', 'Weber', 'García'])}",
        lambda: f"{r.choice(['Anna', 'Thomas', 'Pierre'])} {r.choice(['Schmidt', 'Jones', 'Lefèvre'])}",
        lambda: f"{digits(2)} {r.choice(['Baker', 'Station'])} Street",
        lambda: f"{r.choice(['Haupt', 'Berg', 'Garten'])}straße {1 + r.randrange(98)}",
    ]
    texts, want = [], []
    for i in range(len(make) * 30):
        span = make[i % len(make)]()
        begin = "so it was said that "
        texts.append(f"{begin}{span} came again on the day after and left")
        want.append((len(begin), len(begin) + len(span)))
    plain = [f"Licensed under version {r.randrange(9)}.0.\nsee page {i} for more of it" for i in range(120)]
    mails = [f"mail me at x{i}@mail.example.com today" for i in range(60)]
    got, model = spans_of(spark, texts + plain + mails)
    assert model is not None
    for k in range(len(make)):
        rows = range(k, len(texts), len(make))
        caught = sum(want[i] in [(s.start, s.end) for s in got[i].spans] for i in rows)
        assert caught >= 0.9 * len(rows), (k, caught)
    for i in range(len(texts), len(texts) + len(plain) + len(mails)):
        assert [s for s in got[i].spans if s.k == 4] == []


def test_long_runs_of_proposals_are_linear(spark):
    texts = ["A" * 200_000, "Dr " * 60_000, "Anna" * 50_000, "DE12 " * 40_000, "(123) " * 40_000, "token:" * 30_000, "X" + "a" * 200_000]
    got, _ = spans_of(spark, texts)
    assert len(got) == len(texts)
