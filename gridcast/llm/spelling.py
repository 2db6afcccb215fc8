"""Operator 12: spelling variants grouped by asymmetric q-chunks.

Words are counted over all texts.  Two words are near if one inserted, deleted or
replaced code point turns one into the other; a word's form is its most frequent
near word, if that is frequent enough, and its root is where the forms lead.

Near words come from a join.  One word of a pair (the shorter one) contributes two
disjoint chunks, its halves; one edit leaves one of them whole.  The other word
contributes its positional grams of those lengths; an edit shifts a chunk by at most
one place, so for each of the two lengths that a partner can have the grams that can
equal a chunk are the one at its beginning and the one that ends it.  The
part outside the kept chunk is again a word with one edit, so it is halved the same
way: ``DEPTH`` times for all words, and on for the words of every key that more than
``MOST`` share, until a single code point is left.  Keys are hashes of the length and the kept
chunks; words whose keys are equal are verified with a bounded edit distance inside
the join.

Scale: the texts are read once and only words and counts leave the task (counted
there before the shuffle, so a frequent word is no hot key).  A word has ``2 **
DEPTH`` keys as the shorter and twice as many as the other partner.  A group of
words under one key is at most ``MOST`` words or differs in one place only, so
templates of long equal words with different endings do not meet in all pairs.
Roots come from pointer doubling: counts at least double along a form, which bounds
the rounds by the logarithm of the logarithm of the largest count.

Defined cases: a null text has no words; a null id counts as an empty one for the
contract's deletions; of forms with equal counts the smallest in code-point order
wins; equal rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import ascii_lower, stage_table, text_of

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
DEPTH, MOST = 2, 256
BETWEEN_RUNS = "[^a-zÀ-ÿ]+"


# --- words ------------------------------------------------------------------

def with_deletions(word: Column, doc_id: Column, every: int) -> Column:
    """The word without one code point where ``every`` divides the crc32 of
    ``<doc_id>:<word>``."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)
    h = F.crc32(key.cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def word_counts(docs: DataFrame, delete_every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    runs = docs.select("doc_id", F.explode(F.split(ascii_lower(text_of(F.col("text"))), BETWEEN_RUNS, -1)).alias("run"))
    runs = runs.filter(F.length("run") >= min_length)
    word = with_deletions(F.col("run"), F.col("doc_id"), delete_every) if delete_every else F.col("run")
    counts = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= min_length) & (F.col("n") >= min_count))


# --- near words -------------------------------------------------------------

def _roles(words: DataFrame) -> DataFrame:
    """Each word as it stands before halving: for the length ``m`` of the shorter
    partner the rest is ``word[s:e]``, which is ``r`` long in the shorter one."""
    size = F.length("word").cast("int")
    return (words.select("word", "n", size.alias("size"), F.explode(F.array(size, size - 1)).alias("m"))
            .select("*", F.xxhash64("m").alias("key"), F.lit(0).alias("s"), F.col("size").alias("e"), F.col("m").alias("r")))


def _halve(rows: DataFrame) -> DataFrame:
    """Keys with one more kept chunk: the first half of the rest, or the last."""
    first = F.floor(F.col("r") / 2).cast("int")
    last = F.col("r") - first
    part = [F.struct(F.xxhash64("key", F.lit(0), F.substring("word", F.col("s") + 1, first)).alias("key"),
                     (F.col("s") + first).alias("s"), F.col("e").alias("e"), last.alias("r")),
            F.struct(F.xxhash64("key", F.lit(1), F.substring("word", F.col("e") - last + 1, last)).alias("key"),
                     F.col("s").alias("s"), (F.col("e") - last).alias("e"), first.alias("r"))]
    return rows.select("word", "n", "size", "m", F.explode(F.array(*part)).alias("k")).select("word", "n", "size", "m", "k.*")


def _pairs(rows: DataFrame) -> DataFrame:
    """Near words that share a key: the shorter, or smaller, as ``a``."""
    a = rows.filter("size = m").select("key", F.col("word").alias("a"), F.col("n").alias("an"), F.col("m").alias("am"))
    b = rows.select("key", F.col("word").alias("b"), F.col("n").alias("bn"), F.col("size").alias("bm"))
    near = ((F.col("bm") > F.col("am")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, (a["key"] == b["key"]) & near).select("a", "an", "b", "bn")


def near_words(words: DataFrame, depth: int = DEPTH, most: int = MOST) -> DataFrame:
    """All pairs of near words of a written table ``word, n``, once each."""
    rows = _roles(words)
    for _ in range(depth):
        rows = _halve(rows)
    found = []
    while True:
        # a rest of one code point cannot be halved; its words differ there only
        large = rows.filter("r > 1").groupBy("key").count().filter(F.col("count") > most).select("key")
        large = stage_table(large, "chunk-keys")
        if large.isEmpty():
            break
        stop = (F.col("r") <= 1)
        marked = rows.join(large.withColumn("large", F.lit(True)), "key", "left")
        found.append(_pairs(marked.filter(stop | F.col("large").isNull())))
        rows = _halve(marked.filter(~stop & F.col("large")).drop("large"))
    found.append(_pairs(rows))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


# --- forms and roots --------------------------------------------------------

def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n``: the number of near words and the most
    frequent one, if it is ``ratio`` times as frequent."""
    both = near.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("other_n")),
                                         F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("an").alias("other_n")))).alias("p"))
    best = F.min(F.struct((-F.col("p.other_n")).alias("less"), F.col("p.other").alias("other")))
    best = both.groupBy(F.col("p.word").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form (``found`` is written)."""
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stage_table(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not links.filter("moved").isEmpty()
        links = links.drop("moved")
        if not moved:
            return links


def spelling_variants(docs: DataFrame, delete_every: int | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, depth: int = DEPTH, most: int = MOST) -> DataFrame:
    """All words with ``n``, ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = stage_table(word_counts(docs, delete_every, min_length, min_count), "words")
    found = stage_table(forms(words, near_words(words, depth, most), ratio), "forms")
    return (found.join(roots(found), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
