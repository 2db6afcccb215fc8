"""Operator 7: quality classifier by an interpolated modified Kneser-Ney model.

The model is of 4-grams of real characters (``char_model``), trained on trusted text:
documents whose labels are all good and none toxic.  Tasks count their 4-grams, the
counts meet in a sharded aggregate, and discounts, continuation counts, context totals
and interpolated probabilities are aggregates and joins sharded by n-gram or context.
The tables grow with the corpus and are never gathered: for scoring, the distinct
n-grams of each chunk of texts are joined to them.  Texts are written once, in chunks,
and then stay where they are: labels, probabilities and verdicts come to them.

A document has its perplexity, and that of its ``HARD_RANK``-th hardest word (of
three letters or more).  It is rejected if one of the two is above the quantile of its
language, taken over all trusted documents.  Every text, trusted or not, is scored by
the model that was trained without the fold that its hash is in, so equal texts get equal
results and none is scored by a model that has seen it.  A language
of few trusted documents is drawn smoothly to the quantile of all, moved to its median.

Counts and quantiles cover all trusted documents and scoring covers whole texts.

Defined cases: a null, empty or blank text has null perplexities and is kept;
null is a language of its own; equal rows get equal results; null label values
are not trusted, ids that labels repeat must be good in all; without trusted text
everything is kept with null perplexities; an empty table gives an empty result.

``train`` and ``score`` are the earlier form, a dense table over 48 classes of
characters.  Its tests hold them; the operator does not use them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm import char_model
from gridcast.llm.common import stage_buckets, stage_table

ORDER = 4
CLASSES = 48
#: Folds of the texts.
HELD_PART = 5
QUANTILE = 0.995
#: Documents that the values of all languages count as beside a language's own: for its
#: median (a language varies less in itself than from others), and for its quantile, which fewer than 1 / (1 - QUANTILE) do not settle.
MID_PRIOR, QUANTILE_PRIOR = 0.1, 200
SCORES = ("perplexity", "hard_word")
HARD_RANK = 2
#: Characters scored at a time.
PIECE = 1 << 20

SPACE, DIGITS, STOP, OTHER, UPPER, LETTER, HASHED = 0, 1, 2, 3, 4, 5, 31


# --- characters to classes --------------------------------------------------

@cache
def class_table() -> np.ndarray:
    """Class of each code point: white space, sentence marks, a letter each for a-z,
    other letters by a hash into the remaining classes, and the rest."""
    t = np.full(0x110000, OTHER, np.uint8)
    t[[ord(c) for c in " \t\n\x0b\x0c\r\xa0"]] = SPACE
    t[[ord(c) for c in ".,;:?!'\"()-"]] = STOP
    t[97:123] = LETTER + np.arange(26)
    far = np.array([c for c in range(0x80, 0x30000) if chr(c).isalpha()], np.uint64)
    t[far] = HASHED + (far * np.uint64(2654435761) % np.uint64(1 << 32) % np.uint64(CLASSES - HASHED)).astype(np.uint8)
    return t


@cache
def lower_table() -> np.ndarray:
    """Lower case of each code point where that is one code point."""
    t = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            t[c] = ord(low)
    return t


def classes_of(text: str) -> np.ndarray:
    """Class of each character; runs of space and words with a digit or @ are one symbol."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if not len(raw):
        return np.zeros(0, np.int64)
    low = lower_table()[raw]
    c = class_table()[low]
    space = c == SPACE
    begins = np.r_[True, space[:-1]]
    c = np.where((raw != low) & ~begins, UPPER, c)
    word = np.cumsum(space)
    marked = np.zeros(word[-1] + 1, bool)
    marked[word[((raw >= 48) & (raw < 58)) | (raw == 64)]] = True
    masked = marked[word] & ~space
    c = np.where(masked, DIGITS, c)
    return c[(~masked | begins) & ~(space & begins)].astype(np.int64)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that end at white space where there is some."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        cut = cut if cut > at else at + size
        yield text[at:cut]
        at = cut
    yield text[at:]


def grams_of(c: np.ndarray) -> np.ndarray:
    """4-gram that ends at each character, with space before the first."""
    p = np.r_[0, 0, 0, c]
    return ((p[:-3] * CLASSES + p[1:-2]) * CLASSES + p[2:-1]) * CLASSES + p[3:]


# --- training ---------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES ** ORDER, np.int64)
    for b in batches:
        for t in b.column(0):
            for piece in pieces(t.as_py() or ""):
                g = grams_of(classes_of(piece))
                if len(g) > 50_000:
                    total += np.bincount(g, minlength=len(total))
                else:
                    u, n = np.unique(g, return_counts=True)
                    total[u] += n
    at = np.flatnonzero(total)
    for lo in range(0, len(at), 100_000):
        part = at[lo:lo + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["gram", "n"])


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """(lid) of the documents that labels call good and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    ids = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("lid"))
           .agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).filter("good"))
    return ids.select("lid")


def _discounts(ones: int, twos: int, threes: int, fours: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    if not ones or not twos:
        return [0.5, 0.5, 0.5]
    y = ones / (ones + 2 * twos)
    raw = [1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes if threes else 2.0]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def train(texts: DataFrame) -> np.ndarray | None:
    """Log probabilities of all 4-grams as float32, from a one-column table of texts."""
    counts = texts.mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = {ORDER: stage_table(counts, "grams")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: in how many contexts a shorter n-gram ends a longer one
        counts[k] = counts[k + 1].groupBy((F.col("gram") % F.lit(CLASSES ** k)).alias("gram")).agg(F.count("*").alias("n"))
    lower, table = None, np.full(CLASSES, 1 / CLASSES)
    for k in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(*counts[k].agg(*[F.count(F.when(F.col("n") == i, 1)) for i in (1, 2, 3, 4)]).first())
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        c = counts[k].select("gram", "n", off.alias("off"), F.expr(f"gram div {CLASSES}").alias("ctx"))
        ctx = c.groupBy("ctx").agg(F.sum("n").alias("total"), F.sum("off").alias("freed")).select("ctx", "total", (F.col("freed") / F.col("total")).alias("back"))
        p = c.join(ctx, "ctx")
        if lower is None:
            p = p.withColumn("below", F.lit(1 / CLASSES))
        else:
            p = p.withColumn("tail", F.col("gram") % F.lit(CLASSES ** (k - 1))).join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")
        p = stage_table(p.select("gram", ((F.col("n") - F.col("off")) / F.col("total") + F.col("back") * F.col("below")).alias("p")), f"probabilities-{k}")
        # CLASSES ** k rows at most
        seen, back = p.toPandas(), ctx.select("ctx", "back").toPandas()
        if not len(seen):
            return None
        share = np.ones(CLASSES ** (k - 1))
        share[back["ctx"].to_numpy()] = back["back"].to_numpy()
        # the table of the order below, once for every further symbol of context
        table = share.reshape((-1, 1)) * np.tile(table.reshape((-1, CLASSES)), (CLASSES if k > 1 else 1, 1))
        table = table.ravel()
        table[seen["gram"].to_numpy()] = seen["p"].to_numpy()
        lower = p
    return np.log(table).astype(np.float32)


# --- scoring ----------------------------------------------------------------

def score(text: str | None, logp: np.ndarray) -> tuple[float | None, float | None]:
    """Perplexity of a text and of its hard word."""
    total, n, hard = 0.0, 0, np.zeros(0)
    for piece in pieces(text or ""):
        c = classes_of(piece)
        if not len(c) or (n == 0 and not np.any(c)):
            continue
        lp = logp[grams_of(c)].astype(np.float64)
        total, n = total + lp.sum(), n + len(lp)
        word = np.cumsum(c == SPACE)
        letters = np.bincount(word, weights=c >= LETTER)
        mean = (np.bincount(word, weights=lp) / np.maximum(np.bincount(word), 1))[letters >= 3]
        if len(mean) > HARD_RANK:
            mean = np.partition(mean, HARD_RANK)[:HARD_RANK]
        hard = np.sort(np.r_[hard, mean])[:HARD_RANK]
    if not n:
        return None, None
    return float(np.exp(-total / n)), float(np.exp(-hard[-1])) if len(hard) == HARD_RANK else None


def symbols_of(text: str) -> Iterator[np.ndarray]:
    """Code points of each piece of a text: runs of space are one, and the capital that
    begins a word is lowered."""
    for piece in pieces(text):
        raw = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        if len(raw):
            space = class_table()[raw] == SPACE
            begins = np.r_[True, space[:-1]]
            c = np.where(space, char_model.SPACE, np.where(begins, lower_table()[raw], raw))
            yield c[~(space & begins)]


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def score_symbols(text: str | None, lookup) -> tuple[float | None, float | None]:
    """Perplexity of a text and of its hard word; ``lookup`` gives the log
    probabilities of symbols."""
    total, n, hard = 0.0, 0, np.zeros(0)
    for s in symbols_of(text or ""):
        if not len(s) or (n == 0 and np.all(s == char_model.SPACE)):
            continue
        lp = lookup(s)
        total, n = total + lp.sum(), n + len(lp)
        word = np.cumsum(s == char_model.SPACE)
        letters = np.bincount(word, weights=letter_table()[s])
        mean = (np.bincount(word, weights=lp) / np.maximum(np.bincount(word), 1))[letters >= 3]
        if len(mean) > HARD_RANK:
            mean = np.partition(mean, HARD_RANK)[:HARD_RANK]
        hard = np.sort(np.r_[hard, mean])[:HARD_RANK]
    if not n or np.isnan(total):  # no text, or no model without its fold
        return None, None
    return float(np.exp(-total / n)), float(np.exp(-hard[-1])) if len(hard) == HARD_RANK else None


def _scores(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, DataFrame]:
    """The bucketed texts (chunk, row, m, id, lang, text, doc), and (chunk, row, id, lang, trusted,
    perplexity, hard_word), each by the model without its fold."""
    text = F.col(text_col).cast("string")
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col, lang_col)]
    rows = docs.select(F.spark_partition_id().cast("long").alias("chunk"), F.coalesce(F.octet_length(text), F.lit(0)).alias("row"),
                       F.pmod(F.xxhash64(text, F.lit("fold")), F.lit(HELD_PART)).cast("int").alias("m"),
                       F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"), F.struct(F.lit(0).alias("none"), *rest).alias("doc"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stage_buckets(rows.mapInArrow(char_model.chunked(), rows.schema), "chunks", "chunk", buckets)
    narrow = rows.select("chunk", "row", "id", "lang").join(ids, F.col("id") == F.col("lid"), "left")
    narrow = stage_table(narrow.select("chunk", "row", "id", "lang", F.col("lid").isNotNull().alias("trusted")), "trusted")
    trusted = narrow.filter("trusted").select("chunk", "row")
    model = char_model.train(char_model.counts_in_place(rows, trusted, symbols_of), HELD_PART, _discounts)
    if model[0][-1].isEmpty():
        null = F.lit(None).cast("double")
        return rows, narrow.withColumns({"perplexity": null, "hard_word": null})
    found = char_model.scored(rows.select("chunk", "row", "m", "text"), model, symbols_of, score_symbols)
    return rows, narrow.join(found.drop("m"), ["chunk", "row"])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             label_id_col: str = "doc_id", quantile: float = QUANTILE, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: id, ``lang``, ``perplexity``, ``hard_word``, the two
    limits of its language, ``kept``, and the ``carry`` columns as struct ``doc``."""
    ids = trusted_ids(labels, label_id_col)
    texts, found = _scores(docs, ids, id_col, text_col, lang_col)
    found = stage_table(found, "scored")
    found = verdict(found.drop("trusted"), limits(found.filter("trusted"), quantile))
    if carry:
        place = {c: F.col(f"doc.c{i}") for i, c in enumerate(docs.columns)}
        place |= {id_col: F.col("id"), text_col: F.col("text"), lang_col: F.col("lang")}
        found = _with_rows(texts, found, F.struct(*[place[c].alias(c) for c in carry]))
    return found.drop("chunk", "row").withColumnRenamed("id", id_col)


def _with_rows(texts: DataFrame, found: DataFrame, doc: Column) -> DataFrame:
    """``found`` with ``doc`` of the bucketed texts: a chunk's verdicts, in the order of its
    rows, come to its texts, which are not moved."""
    names = [c for c in found.columns if c not in ("chunk", "row", "id", "lang")]
    of_chunk = found.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("row", *names))).alias("found"))
    rows = texts.select("chunk", "row", "id", "lang", doc.alias("doc")).join(of_chunk, "chunk")
    one = F.get("found", F.col("row"))
    return rows.select("chunk", "row", "id", "lang", *[one[c].alias(c) for c in names], "doc")


def limits(held: DataFrame, quantile: float) -> DataFrame:
    """(lang, perplexity_limit, hard_word_limit): a row per language of ``held`` and one
    without ``seen`` for the others.  A language's quantile is drawn to what all languages
    give, moved to its own median, by as much as its number of documents is small."""
    held = held.select("lang", *[F.log(x).alias(x) for x in SCORES])
    at = lambda x, q: F.percentile_approx(x, F.lit(q), F.lit(10_000))
    own = held.groupBy("lang").agg(F.count("*").alias("n"), *[at(x, 0.5).alias(f"{x}_mid") for x in SCORES], *[at(x, quantile).alias(f"{x}_own") for x in SCORES])
    own = stage_table(own, "languages")  # a row per language, as the other tables that are broadcast here
    away = held.join(F.broadcast(own.withColumnRenamed("lang", "l")), F.col("lang").eqNullSafe(F.col("l")))
    every = F.broadcast(held.agg(*[at(x, 0.5).alias(f"{x}_all") for x in SCORES], *[at(x, quantile).alias(f"{x}_top") for x in SCORES]))
    spread = F.broadcast(away.agg(*[at(F.col(x) - F.col(f"{x}_mid"), quantile).alias(f"{x}_off") for x in SCORES]))
    n = F.col("n")

    def limit(x: str) -> Column:
        mid = (n * F.coalesce(f"{x}_mid", f"{x}_all") + MID_PRIOR * F.col(f"{x}_all")) / (n + MID_PRIOR)
        moved = mid + F.col(f"{x}_off")
        return F.exp((n * F.coalesce(f"{x}_own", moved) + QUANTILE_PRIOR * moved) / (n + QUANTILE_PRIOR)).alias(f"{x}_limit")

    seen = own.crossJoin(every).crossJoin(spread).select(F.lit(True).alias("seen"), "lang", *map(limit, SCORES))
    rest = every.select(F.lit(False).alias("seen"), F.lit(None).cast(held.schema["lang"].dataType).alias("lang"), *[F.exp(f"{x}_top").alias(f"{x}_limit") for x in SCORES])
    return stage_table(seen.unionByName(rest), "limits")


def verdict(rows: DataFrame, found: DataFrame) -> DataFrame:
    names = [f"{x}_limit" for x in SCORES]
    own = F.broadcast(found.filter("seen").select(F.col("lang").alias("l"), *[F.col(x).alias(f"own_{x}") for x in names], F.lit(True).alias("known")))
    out = rows.join(own, F.col("lang").eqNullSafe(F.col("l")), "left").crossJoin(F.broadcast(found.filter("not seen").select(*names)))
    out = out.withColumns({x: F.when(F.col("known"), F.col(f"own_{x}")).otherwise(F.col(x)) for x in names})
    above = [F.coalesce(F.col(x) > F.col(f"{x}_limit"), F.lit(False)) for x in SCORES]
    return out.select(*rows.columns, *names, (~(above[0] | above[1])).alias("kept"))
