"""Sharded character n-gram models: interpolated modified Kneser-Ney over real characters.

A 4-gram is its three characters of context as one 63-bit number (21 bits a code
point) and its last character, so keys are exact for all of Unicode.  White space runs
are one space and the capital that begins a word is lowered; nothing else is folded.

Model ``m`` is trained without fold ``m``.
Counts, discounts, continuation counts and probabilities are tables that grow with the
corpus, sharded by n-gram or context; only four numbers a model and order reach the driver.
An n-gram is one row with a column a model.

Texts are cut into chunks of about ``CHUNK`` bytes where they are read and written once,
bucketed by chunk: neither training nor scoring moves them again.  For scoring, the
distinct n-grams of a chunk are joined to the probabilities and come back to its texts,
so a task holds the n-grams of its chunk and never a model.

Defined cases: a null or empty text has no n-grams; of equal rows each counts; models
without text have no probabilities, and their texts no perplexity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gridcast.llm.common import stage_table

ORDER, BITS = 4, 21
SPACE = 32
#: Bytes of text that are scored together.
CHUNK = 32 << 20
#: What a row counts beside its text, so that empty texts fill a chunk too.
ROW = 64


def grams_of(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and character at each place, with space before the first."""
    p = np.r_[[SPACE] * 3, c].astype(np.int64)
    return (p[:-3] << (2 * BITS)) | (p[1:-2] << BITS) | p[2:-1], p[3:].astype(np.int32)


def keys_of(m: np.ndarray | int, ctx: np.ndarray, c: np.ndarray) -> np.ndarray:
    """64-bit hash of (model, context, character)."""
    with np.errstate(over="ignore"):
        x = ctx.view(np.uint64) ^ (c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x + np.asarray(m).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


Grams = tuple[np.ndarray, np.ndarray, np.ndarray]


def _merged(m: int, parts: list[Grams]) -> Grams:
    """Distinct n-grams of some (ctx, c, n) with their counts."""
    ctx, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, at, back = np.unique(keys_of(m, ctx, c), return_index=True, return_inverse=True)
    return ctx[at], c[at], np.bincount(back, weights=n, minlength=len(at)).astype(np.int64)


def _gathered(symbols: Callable[[str], Iterator[np.ndarray]], most: int = 4 << 20, raw: int = 1 << 20):
    """(group, m, ctx, c, n) of (group, m, text): counts of the texts of a group, which are
    merged every ``raw`` symbols and handed on when a task holds ``most`` distinct n-grams."""
    def rows(group: int, m: int, parts: list[Grams]) -> pa.RecordBatch:
        ctx, c, n = _merged(m, parts)
        k = len(ctx)
        return pa.RecordBatch.from_arrays([pa.array(np.full(k, group, np.int64)), pa.array(np.full(k, m, np.int32)), pa.array(ctx), pa.array(c), pa.array(n)],
                                          names=["chunk", "m", "ctx", "c", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[Grams]] = {}
        size: dict[tuple[int, int], int] = {}
        total = new = 0
        for b in batches:
            for group, m, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for s in symbols(t or ""):
                    if len(s):
                        held.setdefault((group, m), []).append((*grams_of(s), np.ones(len(s), np.int64)))
                        size[group, m] = size.get((group, m), 0) + len(s)
                        new += len(s)
                    if new > raw:
                        held = {k: [_merged(k[1], parts)] if size.get(k) else parts for k, parts in held.items()}
                        size, new = {}, 0
                        total = sum(len(parts[0][0]) for parts in held.values())
                    if total > most:
                        for (g, k), parts in held.items():
                            yield rows(g, k, parts)
                        held, size, total, new = {}, {}, 0, 0
        for (g, k), parts in held.items():
            yield rows(g, k, parts)
    return run


def chunked():
    """Column 0, a partition number, becomes the number of a chunk of about ``CHUNK`` bytes
    and column 1, the bytes of the text, the row's number in its chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size, row = 0, 0, 0
        for b in batches:
            chunk, rows = [], []
            for n in b.column(1).to_pylist():
                n += ROW
                if size and size + n > CHUNK:
                    at, size, row = at + 1, 0, 0
                size += n
                chunk.append(at)
                rows.append(row)
                row += 1
            first = pa.array(np.array(chunk, np.int64) + (b.column(0).to_numpy().astype(np.int64) << 32))
            yield pa.RecordBatch.from_arrays([first, pa.array(rows, pa.int32()), *b.columns[2:]], names=b.schema.names)
    return run


def _tail(k: int) -> Column:
    """Context of the (k - 1)-gram that ends a k-gram."""
    return F.col("ctx").bitwiseAND(F.lit((1 << BITS * (k - 2)) - 1 if k > 2 else 0))


Model = tuple[list[DataFrame], list[DataFrame], list[float]]


def counts_of_texts(texts: DataFrame, symbols) -> DataFrame:
    """(m, ctx, c, n): counts of a table (fold, text), in each task before the shuffle."""
    return texts.select(F.lit(0).cast("long"), "fold", "text").mapInArrow(_gathered(symbols), "chunk long, m int, ctx long, c int, n long")


def train(counts: DataFrame, folds: int, discounts) -> Model:
    """Of the counts (m, ctx, c, n) of the folds ``m`` the models without each fold: for
    the orders from 1 up the probabilities (ctx, c, p0, p1, ...) and back-off weights (ctx,
    b0, b1, ...), a column a model, and each model's share of an unseen character, none
    for a model without text."""
    models = range(folds)
    counts = counts.groupBy("ctx", "c").agg(*[F.sum(F.when(F.col("m") == f, F.col("n")).otherwise(0)).alias(f"n{f}") for f in models])
    every = sum((F.col(f"n{f}") for f in range(1, folds)), F.col("n0"))
    levels = {ORDER: stage_table(counts.select("ctx", "c", *[(every - F.col(f"n{f}")).alias(f"n{f}") for f in models]), "grams")}
    for k in range(ORDER, 1, -1):  # continuation counts: in how many contexts a shorter n-gram ends a longer one
        ends = [F.count_if(F.col(f"n{f}") > 0).alias(f"n{f}") for f in models]
        levels[k - 1] = stage_table(levels[k].groupBy(_tail(k).alias("ctx"), "c").agg(*ends), f"grams-{k - 1}")
    known = levels[1].agg(*[F.count_if(F.col(f"n{f}") > 0) for f in models]).first()
    unseen = [1 / (n + 1) if n else None for n in known]
    probabilities, backs = [], []
    for k in range(1, ORDER + 1):
        # four numbers a model
        ones = levels[k].agg(*[F.count_if(F.col(f"n{f}") == i) for f in models for i in (1, 2, 3, 4)]).first()
        rows = levels[k]
        for f in models:
            d, n = discounts(*ones[4 * f:4 * f + 4]), F.col(f"n{f}")
            rows = rows.withColumn(f"off{f}", F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2]))
        back = rows.groupBy("ctx").agg(*[F.sum(f"n{f}").alias(f"t{f}") for f in models], *[F.sum(f"off{f}").alias(f"b{f}") for f in models])
        share = [F.when(F.col(f"t{f}") > 0, F.col(f"b{f}") / F.col(f"t{f}")).otherwise(1.0).alias(f"b{f}") for f in models]
        back = stage_table(back.select("ctx", *[f"t{f}" for f in models], *share), f"contexts-{k}")
        rows = rows.join(back, "ctx")
        if k == 1:
            rows = rows.withColumns({f"below{f}": F.lit(unseen[f]).cast("double") for f in models})
        else:
            lower = probabilities[-1].select(F.col("ctx").alias("tail"), "c", *[F.col(f"p{f}").alias(f"below{f}") for f in models])
            rows = rows.withColumn("tail", _tail(k)).join(lower, ["tail", "c"])
        own = [F.when(F.col(f"t{f}") > 0, (F.col(f"n{f}") - F.col(f"off{f}")) / F.col(f"t{f}")).otherwise(0.0) for f in models]
        p = [(own[f] + F.col(f"b{f}") * F.col(f"below{f}")).alias(f"p{f}") for f in models]
        probabilities.append(stage_table(rows.select("ctx", "c", *p), f"probabilities-{k}"))
        backs.append(back.select("ctx", *[f"b{f}" for f in models]))
    return probabilities, backs, unseen


def all_log_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(ctx, c, logp) of distinct n-grams (ctx, c), seen in training or not: ``logp`` has
    a value a model.  Only what an order has not seen is sent on to the next lower one."""
    probabilities, backs, unseen = model
    models = range(len(unseen))
    out = None
    left = grams.select("ctx", "c", F.col("ctx").alias("at"), *[F.lit(1.0).alias(f"w{f}") for f in models])
    for k in range(ORDER, 0, -1):
        seen = probabilities[k - 1].withColumnRenamed("ctx", "at").withColumn("seen", F.lit(True))
        found = stage_table(left.join(seen, ["at", "c"], "left"), f"found-{k}", compression="zstd")
        logp = F.array(*[F.log(F.col(f"w{f}") * F.col(f"p{f}")) for f in models])
        hit = found.filter("seen").select("ctx", "c", logp.alias("logp"))
        out = hit if out is None else out.unionByName(hit)
        left = found.filter("seen is null").select("ctx", "c", "at", *[f"w{f}" for f in models])
        left = left.join(backs[k - 1].withColumnRenamed("ctx", "at"), "at", "left")
        shorter = F.col("at").bitwiseAND(F.lit((1 << BITS * (k - 2)) - 1 if k > 2 else 0))
        left = left.select("ctx", "c", shorter.alias("at"), *[(F.col(f"w{f}") * F.coalesce(f"b{f}", F.lit(1.0))).alias(f"w{f}") for f in models])
    rest = F.array(*[F.log(F.col(f"w{f}") * F.lit(unseen[f]).cast("double")) for f in models])
    return out.unionByName(left.select("ctx", "c", rest.alias("logp")))


def log_probabilities(grams: DataFrame, model: Model) -> DataFrame:
    """(m, ctx, c, logp) of distinct n-grams (m, ctx, c)."""
    known = all_log_probabilities(grams.select("ctx", "c").distinct(), model)
    return grams.join(known, ["ctx", "c"]).select("m", "ctx", "c", F.get("logp", F.col("m")).alias("logp"))


def counts_in_place(rows: DataFrame, flags: DataFrame, symbols) -> DataFrame:
    """(m, ctx, c, n) of those texts of bucketed rows (chunk, row, m, text) that ``flags``
    (chunk, row) names.  The flags come to the texts, which stay where they are."""
    gather = _gathered(symbols)

    def of_chunk(texts: pa.Table, named: pa.Table) -> pa.Table:
        use = np.isin(texts.column("row").to_numpy(), named.column("row").to_numpy())
        some = texts.filter(pa.array(use)).select(["chunk", "m", "text"]).combine_chunks()
        parts = list(gather(iter(some.to_batches())))
        table = pa.Table.from_batches(parts) if parts else pa.table({"chunk": pa.array([], pa.int64()), "m": pa.array([], pa.int32()),
                                                                     "ctx": pa.array([], pa.int64()), "c": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        return table.select(["m", "ctx", "c", "n"])
    texts = rows.select("chunk", "row", "m", "text")
    return texts.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(of_chunk, "m int, ctx long, c int, n long")


def scored(rows: DataFrame, model: Model, symbols, score) -> DataFrame:
    """Bucketed rows (chunk, row, m, text, ...) with ``score(text, lookup)`` as ``perplexity``
    and ``hard_word`` in place of the text; ``lookup`` gives log probabilities of symbols.  The distinct n-grams
    of each chunk go to the probabilities and come back to the texts."""
    folds = len(model[2])
    grams = rows.select("chunk", F.lit(0).alias("m"), "text").mapInArrow(_gathered(symbols), "chunk long, m int, ctx long, c int, n long")
    grams = stage_table(grams.select("chunk", "ctx", "c"), "chunk-grams", compression="zstd")
    known = all_log_probabilities(grams.select("ctx", "c").distinct(), model)
    grams = grams.join(known.select("ctx", "c", *[F.col("logp")[f].cast("float").alias(f"l{f}") for f in range(folds)]), ["ctx", "c"])
    names = [c for c in rows.columns if c != "text"]

    def of_chunk(texts: pa.Table, table: pa.Table) -> pa.Table:
        key = keys_of(0, table.column("ctx").to_numpy(), table.column("c").to_numpy())
        key, at = np.unique(key, return_index=True)
        logp = [table.column(f"l{f}").to_numpy()[at].astype(np.float64) for f in range(folds)]
        found = []
        for m, t in zip(texts.column("m").to_pylist(), texts.column("text"), strict=True):
            found.append(score(t.as_py(), lambda s, m=m: logp[m][np.searchsorted(key, keys_of(0, *grams_of(s)))]))
        out = texts.select(names)
        for i, x in enumerate(("perplexity", "hard_word")):
            out = out.append_column(x, pa.array([f[i] for f in found], pa.float64()))
        return out

    schema = StructType([*[f for f in rows.schema.fields if f.name != "text"], StructField("perplexity", DoubleType()), StructField("hard_word", DoubleType())])
    return rows.groupBy("chunk").cogroup(grams.groupBy("chunk")).applyInArrow(of_chunk, schema)
