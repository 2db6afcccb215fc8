"""Operator 5: chat formatting by quotation linking.

Messages quote others in lines that begin with ``>`` marks.  Each message is parsed
into runs of lines of one nesting level; level 0 is its own text, the others are
quoted passages.  Passages are normalised (white space collapsed, lower case),
hashed whole and joined to the earliest message of the same conversation whose own
text says them: if it is an earlier turn, that is the reply edge (the least nested
passage decides, then the latest source).  A message without such a quotation
replies to the message before it.  Conversations come out in reply order, without
the quotes that were linked: every message after the one that it replies to, the
replies to one message one after the other by turn, each with all that hangs on it
(depth first).

What a passage can match.  Own texts are cut at line ends and sentence ends, and
again at sentence ends only (a quotation may be wrapped anew).  Any number of
neighbouring pieces of either cut can be quoted, of any length in characters: a
line, a sentence of a line, two lines of three, a whole message.  A message hashes
its runs of k neighbouring pieces for those k that passages of its conversation
have, so pieces are adjacent by construction and no pairs of equal pieces are formed.
A passage that begins or ends inside a sentence, or that was changed, links nothing.

Reply order.  Messages that follow each other without a link back form a chain of
consecutive turns.  A chain hangs on a message of an earlier chain; its replies go
on first, so what hangs on a chain comes after it, the last place first.  A
message's order key is thus the list of hanging places from the root's chain down
and then its turn.  Keys are found by pointer doubling over the chains: n nested
jumps need log2(n) rounds.

Scale.  No conversation is gathered, however long: messages meet through joins on
(conversation, passage hash) and (conversation, chain), equal passages collapse to
their earliest message before the join, and what runs along the turns of a
conversation is computed inside spans of ``SPAN`` turns and then over the spans.
The result has a row per message, range-partitioned and sorted by conversation and
order key, so a conversation is a run of rows.

Defined cases: null or empty texts are messages without text that quote nobody;
null roles are ``unknown``; messages without conversation id or turn are dropped;
of rows with equal id and turn the least (role, text) is kept; a quotation of a
later message or of an unknown text (an outside text, a prompt like ``>>> f(x)``)
links nothing and stays with its marks; quoted lines without text go unless they
part two passages that stay; a line that introduces a linked passage goes with it;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import SPACES, stage_table, text_of

#: A quoted line: marks with optional spaces between them, then the passage.
QUOTE_RE = r"^[\x20\t]*(?:>[\x20\t]?)+"
MARKS_RE = r"^[\x20\t]*((?:>[\x20\t]?)+)"
#: A line that introduces a quotation; dropped where a quoted line follows it.
INTRO_RE = r"(?i)\b(?:wrote|writes|schrieb|écrit|escribió)\s*:\s*$"
#: Ends of sentences in a normalised text.
SENTENCE_RE = r"(?<=[.!?])\x20"
#: Turns of a conversation that are looked at together.
SPAN = 1024


def _level(line: Column) -> Column:
    """Number of quotation marks a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS_RE, 1), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"\s+", " ")))


def _runs(lines: Column) -> Column:
    """Runs of lines of one level, as (level, start, n, text): quoted lines without
    text are runs of their own, the lines of level 0 are one run up to the next mark."""
    def new(i: Column) -> Column:
        x, y = F.get(lines, i), F.get(lines, i - 1)
        return (i == 0) | (x.level != y.level) | ((x.level > 0) & ((x.text == "") != (y.text == "")))

    n = F.size(lines)
    starts = F.filter(F.sequence(F.lit(0), n - 1), new)

    def run(start: Column, j: Column) -> Column:
        length = F.coalesce(F.get(starts, j + 1), n) - start
        x = F.get(lines, start)
        text = F.when(x.level > 0, F.array_join(F.transform(F.slice(lines, start + 1, length), lambda y: y.text), "\n"))
        return F.struct(x.level.alias("level"), start.alias("start"), length.alias("n"), text.alias("text"))

    return F.transform(starts, run)


def _fine(text: Column) -> Column:
    """Normalised pieces of a text between line ends and sentence ends."""
    lines = F.transform(F.split(text, "\n", -1), normalised)
    return F.filter(F.flatten(F.transform(lines, lambda s: F.split(s, SENTENCE_RE, -1))), lambda p: p != "")


def _sentences(text: Column) -> Column:
    """Normalised pieces of a text between sentence ends, whatever its lines."""
    return F.filter(F.split(normalised(text), SENTENCE_RE, -1), lambda p: p != "")


def parse(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, own, runs): one row per message; ``own`` is its text
    without quoted lines and what introduces them, ``runs`` are (level, start, n, text)
    over its lines, null where it quotes nothing."""
    m = (messages.filter(F.col(conv_col).isNotNull() & F.col(turn_col).isNotNull())
         .groupBy(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"))
         .agg(F.min(F.struct(F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), text_of(F.col(text_col)).alias("text"))).alias("m"))
         .select("conv", "turn", "m.role", "m.text"))
    quoted = F.col("text").rlike("(?m)" + QUOTE_RE)
    lines = F.transform(F.split("text", "\n", -1), lambda s: F.struct(_level(s).cast("int").alias("level"), F.btrim(F.regexp_replace(s, QUOTE_RE, ""), F.lit(SPACES)).alias("text"), s.alias("raw")))
    m = m.withColumn("lines", F.when(quoted, lines))
    plain = F.filter("lines", lambda x, i: (x.level == 0) & ~(x.raw.rlike(INTRO_RE) & (F.coalesce(F.get("lines", i + 1).level, F.lit(0)) > 0)))
    own = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(F.transform(plain, lambda x: x.raw), "\n"))
    return m.select("conv", "turn", "role", "text", own.alias("own"), F.when(F.col("lines").isNotNull(), _runs(F.col("lines"))).alias("runs"))


def quote_links(parsed: DataFrame) -> DataFrame:
    """(conv, turn, quoted, linked_runs): the earlier message that each one answers and
    its runs (from 0) that an earlier message says; messages without such a run are absent."""
    asked = (parsed.filter("runs is not null").select("conv", "turn", F.posexplode("runs").alias("run", "q"))
             .filter("q.level > 0 and q.text <> ''"))
    asked = stage_table(asked.select("conv", "turn", "run", "q.level", F.xxhash64(normalised(F.col("q.text"))).alias("h"),
                                     F.size(_fine(F.col("q.text"))).alias("fine"), F.size(_sentences(F.col("q.text"))).alias("sentences")), "quotes")
    lengths = asked.groupBy("conv").agg(F.collect_set("fine").alias("fine"), F.collect_set("sentences").alias("sentences"))

    def said_runs(pieces: Column, lengths: Column) -> Column:
        n = F.size(pieces)
        return F.flatten(F.transform(F.filter(lengths, lambda k: k <= n), lambda k: F.transform(
            F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.array_join(F.slice(pieces, i, k), " ")))))

    own = (parsed.select("conv", "turn", _fine(F.col("own")).alias("f"), _sentences(F.col("own")).alias("s")).join(lengths, "conv"))
    hashes = F.array_union(said_runs(F.col("f"), F.col("fine")), said_runs(F.col("s"), F.col("sentences")))
    said = own.select("conv", "turn", F.explode(hashes).alias("h")).groupBy("conv", "h").agg(F.min("turn").alias("source"))
    # the least nested quotation is what is answered; deeper ones are its own quotes
    best = F.min(F.struct("level", (-F.col("source")).alias("late")))
    return (asked.join(said, ["conv", "h"]).filter("source < turn").groupBy("conv", "turn")
            .agg(best.alias("best"), F.collect_set("run").alias("linked_runs"))
            .select("conv", "turn", (-F.col("best.late")).alias("quoted"), "linked_runs"))


def content_of(text: Column, runs: Column, linked: Column) -> Column:
    """The text without its linked runs, lines that introduce them and blank marks."""
    gone = F.coalesce(linked, F.array().cast("array<int>"))
    lines = F.split(text, "\n", -1)

    def stays(j: Column) -> Column:  # a passage with text that was not linked
        r = F.get(runs, j)
        return F.coalesce((r.level > 0) & (r.text != "") & ~F.array_contains(gone, j), F.lit(False))

    def part(r: Column, j: Column) -> Column:
        last = F.get(lines, r.start + r.n - 1)
        intro = F.array_contains(gone, j + 1) & last.rlike(INTRO_RE)
        return (F.when(r.level == 0, F.slice(lines, r.start + 1, r.n - intro.cast("int")))
                .when(stays(j) | ((r.text == "") & stays(j - 1) & stays(j + 1)), F.slice(lines, r.start + 1, r.n))
                .otherwise(F.array().cast("array<string>")))

    kept = F.array_join(F.flatten(F.transform(runs, part)), "\n")
    return F.btrim(F.when(runs.isNull(), text).otherwise(kept), F.lit(SPACES))


def _along(rows: DataFrame, value: Column, name: str, running: bool) -> DataFrame:
    """Adds ``name``: the greatest ``value`` of the earlier turns (``running``: and of
    this one) of the conversation, inside spans of turns and then over spans."""
    rows = rows.withColumn("span", F.floor(F.col("turn") / F.lit(SPAN))).withColumn("v", value)
    inside = Window.partitionBy("conv", "span").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0 if running else -1)
    spans = rows.groupBy("conv", "span").agg(F.max("v").alias("v"))
    before = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "span", F.max("v").over(before).alias("earlier"))
    rows = rows.withColumn("here", F.max("v").over(inside)).join(spans, ["conv", "span"])
    return rows.withColumn(name, F.coalesce("here", "earlier")).drop("span", "v", "here", "earlier")


def reply_edges(parsed: DataFrame, links: DataFrame) -> DataFrame:
    """(conv, turn, before, parent, linked): the message that each one replies to, null
    for the first of its conversation."""
    turns = _along(parsed.select("conv", "turn"), F.col("turn"), "before", running=False)
    out = turns.join(links.select("conv", "turn", "quoted"), ["conv", "turn"], "left")
    return out.select("conv", "turn", "before", F.coalesce("quoted", "before").alias("parent"), F.col("quoted").isNotNull().alias("linked"))


def reply_order(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(conv, turn, parent, linked, order_key)."""
    head = F.when(F.col("before").isNull() | (F.col("parent") < F.col("before")), F.col("turn"))
    rows = stage_table(_along(edges, head, "chain", running=True), "reply-chains")
    on = rows.select(F.col("conv").alias("oc"), F.col("turn").alias("ot"), F.col("chain").alias("up"))
    key = "array<struct<hangs:int,place:bigint,chain:bigint>>"
    hung = F.struct(F.lit(1).alias("hangs"), (-F.col("parent")).alias("place"), F.col("chain").alias("chain"))
    state = (rows.filter("chain = turn").join(on, (F.col("conv") == F.col("oc")) & (F.col("parent") == F.col("ot")), "left")
             .select("conv", "chain", "up", F.when(F.col("up").isNull(), F.array().cast(key)).otherwise(F.array(hung)).alias("path")))
    state = stage_table(state, "reply-paths")
    for _ in range(max_rounds):
        if not state.filter("up is not null").limit(1).count():
            break
        above = state.select(F.col("conv").alias("ac"), F.col("chain").alias("au"), F.col("up").alias("next"), F.col("path").alias("above"))
        # each takes over the path of the chain that its own path hangs from
        state = state.join(above, (F.col("conv") == F.col("ac")) & (F.col("up") == F.col("au")), "left")
        path = F.when(F.col("above").isNull(), F.col("path")).otherwise(F.concat("above", "path"))
        state = stage_table(state.select("conv", "chain", F.col("next").alias("up"), path.alias("path")), "reply-paths")
    else:
        raise RuntimeError("replies are nested too deeply")
    own = F.array(F.struct(F.lit(0).alias("hangs"), F.col("turn").alias("place"), F.lit(0).cast("long").alias("chain")))
    return rows.join(state.select("conv", "chain", "path"), ["conv", "chain"]).select("conv", "turn", "parent", "linked", F.concat("path", own).alias("order_key"))


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """One row per message, sorted by conversation and reply order: id, ``turn``,
    ``parent`` (turn replied to), ``linked`` (by a quotation), ``depth`` (hanging places
    above it), ``order_key``, ``role`` and ``content`` (without linked quotes)."""
    parsed = stage_table(parse(messages, conv_col, turn_col, role_col, text_col), "messages")
    links = stage_table(quote_links(parsed), "quote-links")
    order = reply_order(stage_table(reply_edges(parsed, links), "reply-edges"))
    content = content_of(F.col("text"), F.col("runs"), F.col("linked_runs")).alias("content")
    rows = parsed.join(links, ["conv", "turn"], "left").select("conv", "turn", "role", content).join(order, ["conv", "turn"])
    rows = rows.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "parent", "linked", (F.size("order_key") - 1).alias("depth"), "order_key", F.col("role").alias(role_col), "content")
    return rows.repartitionByRange(conv_col, "order_key").sortWithinPartitions(conv_col, "order_key")


def chat_turn(role: Column, content: Column) -> Column:
    """A message in chat-template form; a conversation is its turns joined by newlines."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), content, F.lit("<|im_end|>"))
