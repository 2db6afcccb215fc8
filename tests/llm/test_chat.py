import random

from gridcast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, path string, span int"


def run(spark, rows):
    got = chat.conversations(spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.conv_id, [tuple(k) for k in r.order_key])):
        out.setdefault(r.conv_id, []).append(r)
    return out


def depth_first(parents):
    children = {}
    for t, p in sorted(parents.items()):
        children.setdefault(p, []).append(t)
    order, stack = [], children.get(None, [])[::-1]
    while stack:
        t = stack.pop()
        order.append(t)
        stack += children.get(t, [])[::-1]
    return order


def test_quotes_link_and_go(spark):
    rows = [(1, 0, "user", "How do I join two tables?"),
            (1, 1, "assistant", "Use the join method.\n\nIt takes a key column."),
            (1, 2, "user", "> How do  I JOIN two tables?\nSomebody asked the same today."),
            (1, 3, "assistant", "Ann wrote:\n> > How do I join two tables?\n> It takes a key column.\nWhich one is it?"),
            (1, 4, "user", "The first column."),
            (1, 5, "user", "> nobody ever said this\nreally"),
            (2, 0, "user", "> It takes a key column.\nother conversation")]
    got = run(spark, rows)
    one = {r.turn: r for r in got[1]}
    assert {t: (r.parent, r.linked) for t, r in one.items()} == {
        0: (None, False), 1: (0, False), 2: (0, True), 3: (1, True), 4: (3, False), 5: (4, False)}
    assert [r.turn for r in got[1]] == [0, 1, 3, 4, 5, 2]
    assert one[2].content == "Somebody asked the same today." and one[3].content == "Which one is it?"
    # what nobody said before, or only in another conversation, is not a quotation
    assert one[5].content == "> nobody ever said this\nreally"
    assert got[2][0].content == "> It takes a key column.\nother conversation" and got[2][0].parent is None


def test_prompts_and_outside_quotations_stay(spark):
    text = ">>> f(x)\n42\n> an outside text\n>\n> nobody here said\nend"
    got = run(spark, [(1, 0, "user", "start"), (1, 1, "user", text), (1, 2, "user", "Bob wrote:\n> an outside one\nno")])
    assert [x.content for x in got[1]] == ["start", text, "Bob wrote:\n> an outside one\nno"]


def test_parts_of_a_message_link_whatever_their_length(spark):
    rows = [(1, 0, "u", "Thanks!"),
            (1, 1, "u", "First line of three\nsecond line\nthird line\n\nNow a sentence. And another one that is\nwrapped here. Ok?"),
            (1, 2, "u", "something else"),
            (1, 3, "u", "> Thanks!\na"), (1, 4, "u", "> second line\n> third line\nb"), (1, 5, "u", "> And another one\n> that is wrapped here.\nc"),
            (1, 6, "u", "> ok?\n> something else\nd"), (1, 7, "u", "> First line of three\n> third line\ne"), (1, 8, "u", "> ok?\n\n> something else\nf")]
    got = {x.turn: x for x in run(spark, rows)[1]}
    assert {t: (x.parent, x.linked) for t, x in got.items() if t > 2} == {
        3: (0, True), 4: (1, True), 5: (1, True), 6: (5, False), 7: (6, False), 8: (2, True)}
    assert [got[t].content for t in range(3, 9)] == ["a", "b", "c", rows[6][3], rows[7][3], "f"]


def brute_links(texts):
    """(source or None, own lines kept) of messages of one conversation, by substring
    of whole pieces."""
    import re
    norm = lambda s: " ".join(s.split()).lower()
    own, out = [], []
    for t in texts:
        groups = []
        for line in t.split("\n"):
            level = re.match(r"[ \t]*((?:>[ \t]?)*)", line).group(1).count(">")
            groups += [] if groups and groups[-1][0] == level else [(level, [])]
            groups[-1][1].append(line)
        found, keep = [], []
        for level, lines in groups:
            passage = norm(" ".join(re.sub(r"^[ \t]*(?:>[ \t]?)+", "", x) for x in lines))
            source = next((i for i, pieces in enumerate(own) if level and any(
                passage == " ".join(p[a:b]) for p in pieces for a in range(len(p)) for b in range(a + 1, len(p) + 1))), None)
            if source is not None:
                found.append((level, -source))
            else:
                keep += lines
        mine = [x for level, lines in groups if not level for x in lines]
        cut = lambda s: [p for p in re.split(r"(?<=[.!?]) ", norm(s)) if p]
        own.append(([p for x in mine for p in cut(x)], cut("\n".join(mine))))
        out.append((-min(found)[1] if found else None, "\n".join(keep).strip()))
    return out


def test_links_match_brute_force(spark):
    r, rows, want = random.Random(8), [], {}
    pieces = ["a.", "b!", "yes", "no way", "Ok?", "the end", "c. d"]
    for c in range(60):
        texts = []
        for _ in range(8):
            lines = []
            for _ in range(r.randrange(1, 5)):
                lines.append("> " * r.choice([0, 0, 1, 1, 2]) + " ".join(r.choices(pieces, k=r.randrange(1, 4))))
            texts.append("\n".join(lines))
        want[c] = brute_links(texts)
        rows += [(c, t, "u", x) for t, x in enumerate(texts)]
    got = run(spark, rows)
    assert sum(s is not None for w in want.values() for s, _ in w) > 40
    for c, w in want.items():
        for x in got[c]:
            source, content = w[x.turn]
            assert (x.linked, x.content) == (source is not None, content)
            assert x.parent == (source if source is not None else (x.turn - 1 if x.turn else None))


def test_order_is_depth_first_on_random_trees(spark):
    r, rows, want = random.Random(3), [], {}
    for c in range(25):
        parents = {0: None}
        rows.append((c, 0, "user", f"message number 0 of {c}"))
        turns = [0]
        for _ in range(r.randrange(1, 40)):
            t = turns[-1] + r.randrange(1, 600)  # gaps, over several spans
            p = r.choice([turns[-1], r.choice(turns)])
            parents[t] = p
            quote = "" if p == turns[-1] and r.random() < 0.5 else f">message number {p} of {c}\n"
            rows.append((c, t, "user", f"{quote}message number {t} of {c}"))
            turns.append(t)
        want[c] = depth_first(parents)
    r.shuffle(rows)
    got = run(spark, rows)
    for c, order in want.items():
        assert [x.turn for x in got[c]] == order


def test_long_conversation_and_deep_jumps(spark):
    n = 3000
    rows = [(7, t, "user", f"statement number {t} here") for t in range(n)]
    # a comb: every reply quotes the message two before it, so every message hangs
    rows += [(8, t, "user", (f"> statement number {t - 2} here\n" if t > 1 else "") + f"statement number {t} here") for t in range(60)]
    got = run(spark, rows)
    assert [x.turn for x in got[7]] == list(range(n)) and all(x.depth == 0 for x in got[7])
    parents = {t: t - 2 if t > 1 else (0 if t == 1 else None) for t in range(60)}
    assert [x.turn for x in got[8]] == depth_first(parents)


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "user", ""), (1, 2, "user", ">"), (1, 3, "user", "> \n> \n"), (1, 3, "user", "a later copy"),
            (None, 0, "user", "x"), (2, None, "user", "x"), (3, 5, "user", "> quoted quoted quoted"), (3, 6, "b", "quoted quoted quoted")]
    got = run(spark, rows)
    assert sorted(got) == [1, 3]
    assert [(x.turn, x.role, x.content) for x in got[1]] == [(0, "unknown", ""), (1, "user", ""), (2, "user", ""), (3, "user", "")]
    assert [(x.turn, x.parent, x.linked) for x in got[3]] == [(5, None, False), (6, 5, False)]
    assert chat.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_partitions_hold_runs_of_conversations(spark):
    rows = [(c, t, "user", f"m {t}") for c in range(30) for t in range(10)]
    df = chat.conversations(spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA))
    parts = df.rdd.mapPartitions(lambda it: [[(r.conv_id, r.turn) for r in it]]).collect()
    assert [x for p in parts for x in p] == [(c, t) for c in range(30) for t in range(10)]
