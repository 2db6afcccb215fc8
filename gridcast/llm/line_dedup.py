"""Operator 3: near-duplicate lines by a deletion-neighbourhood join.

A line is the sequence of its words, and the edit bound is one word inserted,
deleted or replaced.  A line goes if an earlier one (by document id, then line)
is equal to it or, where it has ``near_words`` words or more, within the bound.

Equal lines are collapsed to their earliest place first.  A distinct line then
emits every variant within the bound as a hashed key: the line less one word, once
with the position (two lines of one length that differ there meet) and once
without (it meets the line that is one word shorter).  Each key keeps its earliest
line and the line that it is, each line the earliest partner over its keys; the
texts of line and partner are then compared word by word, and a partner that is
not within the bound (equal hashes of different texts) is dropped.

Ahead of that, lines that cannot have a partner are dropped without loss: of two
lines within the bound, one half of the longer one's length is equal at the
beginning or at the end, so a line whose halves nobody shares emits nothing.

Scale.  A key, however hot, is one row per task after the map-side combine, and
only sums come back by joins that split skewed keys; pairs inside a group are
never formed.  Texts are moved for lines with a partner only.

Defined cases: a null text has no lines and stays null; lines without a word are
kept as they are; lines of fewer than ``near_words`` words (one or two) are dropped
for equal ones only, whatever stands near them; null ids come last; rows that are equal in id and text count as one and get
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import SPACE_RE, SPACES, stage_table, text_of

#: Lines of fewer words go for equal ones only: one word of two is another line.
NEAR_WORDS = 3


def words_within(a: list, b: list) -> bool:
    """Whether two word lists are equal or one word apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


# --- lines and their halves --------------------------------------------------

def _place(id_col: str = "id") -> Column:
    """Sortable place of a line: id (null last), text, line."""
    return F.struct(F.col(id_col).isNull().alias("x"), F.col(id_col).alias("id"), "text_hash", "line")


def normalised(line: Column) -> Column:
    """The words of a line with one space between them."""
    t = F.btrim(line, F.lit(SPACES))
    return F.when(t.rlike(r"[\t\x0b\x0c\r]|\x20\x20"), F.regexp_replace(t, SPACE_RE, " ")).otherwise(t)


def _first(s: Column, k: Column) -> Column:
    return F.call_function("substring_index", s, F.lit(" "), k)


def _halves(x: Column, near_words: int) -> Column:
    """Keys that a line shares with every line within the bound: its beginning and its
    end of half its own length and of half the next length."""
    keys = []
    for longer in (0, 1):
        m = x.n + longer
        head = F.floor(m / 2).cast("int")
        keys += [F.xxhash64(m, F.lit("head"), _first(x.s, head)), F.xxhash64(m, F.lit("tail"), _first(x.s, head - m))]
    return F.when(x.n >= near_words, F.array(*keys)).otherwise(F.array().cast("array<long>"))


def _hashed(docs: DataFrame, id_col: str, text_col: str, near_words: int) -> DataFrame:
    """(id, text_hash, lines): per document the lines that have a word, as (line, h, halves)."""
    parts = F.transform(F.split(text_of(F.col(text_col)), "\n", -1), lambda s, i: F.struct(i.alias("line"), normalised(s).alias("s")))
    counted = F.transform(F.filter(parts, lambda x: x.s != ""), lambda x: F.struct(
        x.line.alias("line"), x.s.alias("s"), (F.regexp_count(x.s, F.lit(" ")) + 1).alias("n")))
    lines = F.transform(counted, lambda x: F.struct(x.line.alias("line"), F.xxhash64(x.s).alias("h"), _halves(x, near_words).alias("halves")))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), lines.alias("lines"))


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text_hash, line, h, words) of the wanted lines (line, h) of each text."""
    for b in batches:
        row, line, h, words = [], [], [], []
        for r, (t, wanted) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
            lines = t.split("\n")
            for x in wanted:
                row.append(r)
                line.append(x["line"])
                h.append(x["h"])
                words.append([w for w in re.split(SPACE_RE, lines[x["line"]]) if w])
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(line, pa.int32()), pa.array(h, pa.int64()),
                                          pa.array(words, pa.list_(pa.string()))], names=["id", "text_hash", "line", "h", "words"])


# --- the deletion neighbourhood ----------------------------------------------

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _mixed(x: np.ndarray, salt) -> np.ndarray:
    """A key from the hash of a word list and what else must be equal."""
    x = (x ^ np.asarray(salt, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def neighbourhood(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a line: less each word with its position, less each word without it,
    and of the line itself."""
    import xxhash
    n = len(words)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, n)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(n, _FACTOR, np.uint64))
        upto = np.r_[np.uint64(0), np.cumsum(h * powers)]
        less = upto[:-1] + (upto[-1] - upto[1:]) * np.uint64(_INVERSE)
        at = np.arange(n, dtype=np.uint64)
        return (_mixed(less, (np.uint64(n) << np.uint64(33)) + (at << np.uint64(1)) + np.uint64(1)),
                _mixed(less, np.uint64((n - 1) << 33)), _mixed(upto[-1:], np.uint64(n << 33)))


def _variants(near_words: int):
    """(h, key, kind) of each line: kind 0 less a word with position, 1 less a word, 2 itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                h, key, kind = [], [], []
                for x, words in zip(b.column(0).slice(lo, 2000).to_pylist(), b.column(1).slice(lo, 2000).to_pylist(), strict=True):
                    placed, less, own = neighbourhood([w.encode("utf-8", "surrogatepass") for w in words])
                    if len(words) <= near_words:
                        less = less[:0]  # a shorter line than the bound applies to
                    parts = (np.unique(placed), np.unique(less), own)
                    key += parts
                    kind += [np.full(len(p), k, np.int8) for k, p in enumerate(parts)]
                    h.append(np.full(sum(map(len, parts)), x, np.int64))
                if h:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), pa.array(np.concatenate(key).view(np.int64)),
                                                      pa.array(np.concatenate(kind))], names=["h", "key", "kind"])
    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h) of the pairs (h, words, partner's words) that are within the bound."""
    for b in batches:
        ok = [words_within(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_()))], names=["h"])


# --- operator ---------------------------------------------------------------

def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = NEAR_WORDS) -> DataFrame:
    """One row per document row: id, ``text_hash``, ``n_lines`` (with a word),
    ``n_equal`` and ``n_near`` (gone because of an equal or a near line), and
    ``kept``, the numbers of the kept lines with a word, from 0."""
    hashed = stage_table(_hashed(docs, id_col, text_col, near_words), "lines")
    lines = hashed.select("id", "text_hash", F.explode("lines").alias("x")).select("id", "text_hash", "x.*")
    distinct = stage_table(lines.groupBy("h").agg(F.min(_place()).alias("place"), F.first("halves").alias("halves")), "distinct-lines")
    halves = distinct.select("h", F.explode("halves").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    wanted = halves.join(shared, "key", "left_semi").select(F.col("h").alias("wh")).distinct()
    wanted = distinct.select("h", "place").join(wanted, F.col("h") == F.col("wh"), "left_semi")
    # of each document the lines wanted, no more than it has
    wanted = (wanted.groupBy(F.xxhash64("place.id").alias("wi"), F.col("place.text_hash").alias("wt"))
              .agg(F.collect_list(F.struct("place.line", "h")).alias("wanted")))
    # the wanted lines are the built side; texts are moved once and not sorted
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("i"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(wanted.hint("shuffle_hash"), (F.col("i") == F.col("wi")) & (F.col("text_hash") == F.col("wt"))).select("id", "text_hash", "text", "wanted")
    id_type = rows.schema["id"].dataType.simpleString()
    texts = rows.mapInArrow(_picked, f"id {id_type}, text_hash long, line int, h long, words array<string>")
    texts = stage_table(texts.select("h", "words", _place().alias("place")).dropDuplicates(["h"]), "line-texts")
    keys = texts.select("h", "words").mapInArrow(_variants(near_words), "h long, key long, kind byte")
    keys = stage_table(keys, "line-variants")
    places = texts.select(F.col("h").alias("ph"), "place")
    placed = keys.join(places, F.col("h") == F.col("ph")).select("key", "kind", "h", "place")
    met = (placed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("kind") < 2, F.col("place"))).alias("variant"),
                                     F.min(F.when(F.col("kind") == 2, F.col("place"))).alias("own")).filter("n > 1"))
    partner = F.when(F.col("kind") == 1, F.col("own")).otherwise(F.col("variant"))
    pairs = (placed.join(met.drop("n"), "key").select("h", "place", partner.alias("partner")).filter(F.col("partner") < F.col("place"))
             .groupBy("h").agg(F.min("partner").alias("partner")))
    mine = texts.select("h", "words")
    other = texts.select(F.col("place").alias("partner"), F.col("words").alias("partner_words"))
    near = pairs.join(mine, "h").join(other, "partner").select("h", "words", "partner_words").mapInArrow(_verified, "h long").distinct()
    survivors = distinct.join(near, "h", "left_anti").select("place")
    kept = (survivors.groupBy(F.col("place.id").alias("kid"), F.col("place.text_hash").alias("kth"))
            .agg(F.array_sort(F.collect_set("place.line")).alias("kept")))
    dropped_near = near.select("h")
    first = distinct.join(dropped_near, "h", "left_semi").select(F.col("place.id").alias("nid"), F.col("place.text_hash").alias("nth"))
    n_near = first.groupBy("nid", "nth").agg(F.count("*").alias("n_near"))
    n_lines = hashed.select("id", "text_hash", F.size("lines").cast("long").alias("n_lines"))
    zero = F.lit(0).cast("long")
    out = (n_lines.join(kept, F.col("id").eqNullSafe(F.col("kid")) & (F.col("text_hash") == F.col("kth")), "left")
           .join(n_near, F.col("id").eqNullSafe(F.col("nid")) & (F.col("text_hash") == F.col("nth")), "left"))
    out = out.select(F.col("id").alias(id_col), "text_hash", "n_lines", F.coalesce("n_near", zero).alias("n_near"),
                     F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))
    return out.withColumn("n_equal", F.col("n_lines") - F.col("n_near") - F.size("kept"))


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) with the lines that are kept, wordless lines as they are."""
    for b in batches:
        texts = []
        for t, kept in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if t is not None:
                kept = set(kept or ())
                t = "\n".join(x for i, x in enumerate(t.split("\n")) if i in kept or not x.strip(SPACES))
            texts.append(t)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_words: int = NEAR_WORDS) -> DataFrame:
    """Every document row's id and its text without the lines that go."""
    kept = kept_lines(docs, id_col, text_col, near_words).select(F.col(id_col).alias("kid"), F.col("text_hash").alias("kth"), "kept").dropDuplicates(["kid", "kth"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_hash"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kid")) & (F.col("text_hash") == F.col("kth")), "left").select("id", "text", "kept")
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_rebuilt, f"id {id_type}, text string").withColumnsRenamed({"id": id_col, "text": text_col})
