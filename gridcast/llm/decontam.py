"""Operator 2: benchmark decontamination by winnowing.

A document word is hit when it lies inside an occurrence of a benchmark window:
``window`` consecutive words of an item, or all words of a shorter, non-empty item.

Words are hashed, ``k`` of them in a row make a k-gram, and of every ``w``
consecutive k-grams the one with the least hash (the last of equal ones) is kept
as a fingerprint.  Two texts that share a span of ``k + w - 1`` words keep the
same fingerprint inside it, so with ``k + w - 1`` equal to the window length no
shared window is missed.  Items shorter than the window are served by classes of
smaller ``(k, w)``; a class costs nothing when no item falls into it.

Document and item fingerprints are joined; each hit is extended to both sides
while the words agree, as far as a window around the k-gram can reach, and counts
if the agreeing span is a whole window.  Ahead of the join a bitmap of bounded
size, made of the item fingerprints, drops document k-grams that no item has: a
pure reduction, since the join decides.  Nothing of unbounded size is broadcast
and texts are never shuffled.

Native DataFrame functions only.

Defined cases: a null or wordless text has no words, no hits and is clean; equal
rows get equal results; rows that share an id but not the text are judged apart;
an item without id marks words but is not counted or listed; empty tables give an
empty or an all-clean result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import ascii_lower, stage_table, text_of

WINDOW = 13
#: A document is contaminated if at least 1 / CLEAN_SHARE of its words is hit.
CLEAN_SHARE = 20
NOT_WORD_RE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most bits of the bitmap ahead of the join (128 KB).
MAX_BITS = 1 << 20


@dataclass(frozen=True)
class Class:
    """Items whose window has ``least`` to ``most`` words; ``k + w - 1 == least``."""
    least: int
    most: int
    k: int
    w: int

    @property
    def reach(self) -> int:
        """How far a window can stand out from a k-gram inside it."""
        return self.most - self.k


def classes_for(window: int) -> list[Class]:
    """The class of whole windows and those of shorter items, down to one word."""
    out, most, least = [], window, window
    while most:
        k = (least + 1) // 2
        out.append(Class(least, most, k, least - k + 1))
        most = least - 1
        least = most // 2 + 1
    return out


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(ascii_lower(text_of(text)), NOT_WORD_RE, -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(h: Column, k: int) -> Column:
    """Hash of the k-gram that begins at each word but the last k - 1."""
    heads = F.slice(h, F.lit(1), F.greatest(F.size(h) - (k - 1), F.lit(0)))
    if k == 1:
        return heads
    return F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))


def _is_kept(g: Column, p: Column, w: int) -> Column:
    """Whether position ``p`` is the least, or last of equal least ones, of some
    window of ``w`` k-grams."""
    if w == 1:
        return F.lit(True)
    lo, hi = F.greatest(p - (w - 1), F.lit(0)), F.least(p, F.size(g) - w)
    x = F.get(g, p)
    starts = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    # nothing less from the window's start on, nothing less or equal after p
    return F.exists(starts, lambda s: (F.array_min(F.slice(g, s + 1, F.lit(w))) == x)
                    & ~F.exists(F.slice(g, p + 2, F.greatest(s + (w - 1) - p, F.lit(0))), lambda y: y == x))


def _fingerprints(h: Column, g: Column, c: Class, test) -> Column:
    """Array of (p, fp, before, after): kept k-grams that pass ``test``, with the
    word hashes around them, nearest first."""
    at = F.filter(F.transform(g, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())
    kept = F.filter(at, lambda p: _is_kept(g, p, c.w))
    return F.transform(kept, lambda p: F.struct(
        p.alias("p"), F.get(g, p).alias("fp"),
        F.reverse(F.slice(h, F.greatest(p - c.reach, F.lit(0)) + 1, F.least(p, F.lit(c.reach)))).alias("before"),
        F.slice(h, p + (c.k + 1), F.lit(c.reach)).alias("after")))


def _tagged(n: int):
    """Puts the class number before a fingerprint's fields."""
    return lambda f: F.struct(F.lit(n).alias("c"), f.p.alias("p"), f.fp.alias("fp"),
                              f.before.alias("before"), f.after.alias("after"))


def _common(a: Column, b: Column) -> Column:
    """Length of the common beginning of two arrays."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ == 0, F.size(a)).otherwise(differ.cast("int") - 1)


def item_fingerprints(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(c, item, need, fp, before, after) for the kept k-grams of every item."""
    h = items.select(F.col(id_col).cast("string").alias("item"), word_hashes(F.col(text_col)).alias("h"))
    h = h.select("item", "h", F.least(F.size("h"), F.lit(window)).alias("need"))
    out = None
    for n, c in enumerate(classes_for(window)):
        mine = h.filter(F.col("need").between(c.least, c.most)).select("item", "need", "h", _grams(F.col("h"), c.k).alias("g"))
        rows = (mine.select("item", "need", F.explode(_fingerprints(F.col("h"), F.col("g"), c, lambda x: F.lit(True))).alias("f"))
                .select(F.lit(n).alias("c"), "item", "need", "f.fp", "f.before", "f.after"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _bitmap(fps: DataFrame) -> tuple[dict[int, int], list[int], int]:
    """Item fingerprints by class, and a bitmap of all of them: words of 64 bits and
    their number, a power of two that follows the fingerprints up to MAX_BITS."""
    counts = dict(map(tuple, fps.groupBy("c").agg(F.count("*")).collect()))  # a row for each class at most
    n_words = 16
    while n_words * 64 < 16 * sum(counts.values()) and n_words * 64 < MAX_BITS:
        n_words *= 2
    slot, bit = _slot(F.col("fp"), n_words)
    words = fps.select(slot.alias("s"), bit.alias("b")).groupBy("s").agg(F.bit_or(F.expr("shiftleft(1L, b)")))
    found = dict(map(tuple, words.collect()))  # n_words rows at most
    return counts, [found.get(i, 0) for i in range(n_words)], n_words


def _slot(fp: Column, n_words: int) -> tuple[Column, Column]:
    return (fp.bitwiseAND(F.lit(n_words - 1).cast("long")).cast("int"),
            F.shiftrightunsigned(fp, 58).cast("int"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document row: id, ``text_hash`` (xxhash64 of the text), ``n_words``,
    ``n_hit``, ``n_items``, ``items`` (sorted ids), ``contaminated``."""
    fps = stage_table(item_fingerprints(items, item_id_col, item_text_col, window), "item-fingerprints")
    counts, bits, n_words = _bitmap(fps)
    kinds = {n: c for n, c in enumerate(classes_for(window)) if n in counts}
    bitmap = F.from_json(F.lit(str(bits)), "array<bigint>")

    def listed(x: Column) -> Column:
        slot, bit = _slot(x, n_words)
        return F.getbit(F.get(bitmap, slot), bit) == 1

    read = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), word_hashes(F.col(text_col)).alias("h"))
    read = read.select("*", *[_grams(F.col("h"), c.k).alias(f"g{n}") for n, c in kinds.items()])
    none = F.array().cast("array<struct<c:int,p:int,fp:bigint,before:array<bigint>,after:array<bigint>>>")
    found = [F.transform(_fingerprints(F.col("h"), F.col(f"g{n}"), c, listed), _tagged(n)) for n, c in kinds.items()]
    read = stage_table(read.select("id", "text_hash", F.size("h").cast("long").alias("n_words"),
                                   (F.concat(none, *found) if found else none).alias("found")), "document-fingerprints")

    k_of = F.element_at(F.create_map(*[F.lit(x) for n, c in enumerate(classes_for(window)) for x in (n, c.k)]), F.col("d.c"))
    d = read.select("id", "text_hash", F.explode("found").alias("d"))
    f = fps.select(F.col("c").alias("ic"), F.col("fp").alias("ifp"), "item", "need", F.col("before").alias("ib"), F.col("after").alias("ia"))
    hits = (d.join(f, (d.d.c == f.ic) & (d.d.fp == f.ifp))
            .select("id", "text_hash", "item", "need", k_of.alias("k"), "d.p",
                    _common(F.col("d.before"), F.col("ib")).alias("left"), _common(F.col("d.after"), F.col("ia")).alias("right"))
            .filter("left + k + right >= need")
            .select("id", "text_hash", "item", (F.col("p") - F.col("left")).alias("lo"), (F.col("p") + F.col("k") + F.col("right")).alias("hi")))
    by_doc = hits.groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    n_hit = F.aggregate("spans", start, lambda a, s: F.struct(
        (a.n + F.greatest(s.hi - F.greatest(s.lo, a.upto), F.lit(0))).alias("n"), F.greatest(a.upto, s.hi).alias("upto")), lambda a: a.n)
    by_doc = by_doc.select(F.col("id").alias("hid"), F.col("text_hash").alias("hth"), n_hit.cast("long").alias("n_hit"), "items")
    out = read.join(by_doc, F.col("id").eqNullSafe(F.col("hid")) & (F.col("text_hash") == F.col("hth")), "left")
    out = out.select(F.col("id").alias(id_col), "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                     F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select("*", F.size("items").cast("long").alias("n_items"),
                      ((F.col("n_hit") > 0) & (CLEAN_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
