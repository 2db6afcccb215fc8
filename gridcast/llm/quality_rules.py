"""Operator 1: quality rules learned as a decision list.

``measure`` gives each text its statistics.  ``learn`` builds an ordered list of
rejecting rules by sequential covering: a rule grows one threshold condition at a
time by information gain on the growing part of the labelled rows, loses its last
conditions while that helps on the pruning part, is taken only if it is precise
and supported there, and the rows it covers leave before the next rule.
``Rules.expression`` is the list as one ordered conditional Spark expression.

Labelled rows are the only thing sampled: at most ``max_labelled`` labelled ids,
those of least hash, take part in fitting (the bound makes them safe to
broadcast).  Every search step is one aggregate on the cluster; the driver sees
counts by feature and bin.  Statistics and verdicts cover all documents.  Native
DataFrame functions only.

Defined cases: a null or wordless text has zero in every statistic and fails the
base check; ids that labels repeat count as bad if one of the labels is; labels
with null in both columns are not used; without usable labels, or without bad or
good ones, the list is empty and the base check alone decides; equal rows get
equal results; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import NOT_SPACE_RE, stage_table, text_of, words_of

SYMBOLS_RE = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LABELLED = 20_000
#: Bins of a feature; thresholds are the edges between them.
BINS = 32
#: A term is the first letters of a word; the list of telling terms is bounded.
TERM_RE = r"(?<!\p{L})\p{L}{4}"
MAX_TERMS = 400

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- statistics -------------------------------------------------------------

def _covered(starts: Column, width: int) -> Column:
    """Positions inside windows of ``width`` that begin at sorted ``starts``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(starts, zero, lambda a, s: F.struct(
        (a.n + s + width - F.greatest(s, a.upto)).alias("n"), (s + width).alias("upto")), lambda a: a.n)


def _in_terms(text: Column, terms: list[str]) -> Column:
    if not terms:
        return F.lit(0)
    return F.size(F.filter(F.regexp_extract_all(F.lower(text), F.lit(TERM_RE), F.lit(0)), lambda t: t.isin(terms)))


def measure(docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """id, ``text_hash``, the base statistics and those that only rules use."""
    text = text_of(F.col(text_col))
    t = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), text.alias("text"),
                    words_of(F.col(text_col)).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NOT_SPACE_RE))
    t = t.select("id", "text_hash", F.size("words").cast("long").alias("n_words"),
                 F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.regexp_count("text", F.lit(SYMBOLS_RE)).cast("long").alias("n_symbols"),
                 F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
                 F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
                 F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
                 _in_terms(F.col("text"), terms).cast("long").alias("n_terms"),
                 lines.alias("lines"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    t = t.withColumn("g", F.transform(F.slice("h", F.lit(1), F.greatest(F.size("h") - 2, F.lit(0))),
                                      lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2))))
    # sorted only where some window repeats; equal windows then stand together
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    t = t.withColumn("s", F.when(repeats, F.array_sort(F.transform("g", lambda x, i: F.struct(x.alias("k"), i.alias("p"))))))
    again = F.filter("s", lambda x, i: (F.get("s", i - 1).k == x.k) | (F.get("s", i + 1).k == x.k))
    t = t.withColumn("starts", F.array_sort(F.transform(again, lambda x: x.p)))
    return t.select("id", "text_hash", "n_words", "word_chars", "n_symbols",
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    F.coalesce(_covered(F.col("starts"), 3), F.lit(0)).cast("long").alias("n_repeat_words"),
                    F.size("lines").cast("long").alias("n_lines"), "n_upper", "n_digits", "n_distinct", "n_terms")


def _share(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))


def features() -> dict[str, Column]:
    """The tested quantities as expressions over the columns of :func:`measure`."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "repeated_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "upper": _share("n_upper", "word_chars"),
        "digits": _share("n_digits", "word_chars"),
        "distinct_words": _share("n_distinct", "n_words"),
        "telling_terms": F.col("n_terms").cast("double"),
        "telling_share": _share("n_terms", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# --- learning ---------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def test(self) -> Column:
        x = features()[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


@dataclass
class Rules:
    """Ordered rejecting rules, each a conjunction of conditions."""
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    terms: list[str] = field(default_factory=list)

    def expression(self) -> Column:
        """Number of the first rule that holds, from 1; null if none does."""
        out = F.lit(None).cast("int")
        for n in range(len(self.rules), 0, -1):
            out = F.when(_all(self.rules[n - 1]), F.lit(n)).otherwise(out)
        return out


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.test()
    return out


def labelled_sample(labels: DataFrame, id_col: str, max_labelled: int) -> DataFrame:
    """(lid, bad, part): at most ``max_labelled`` labelled ids, those of least hash."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    one = (labels.filter(F.col(id_col).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
           .groupBy(F.col(id_col).alias("lid")).agg(F.max(bad).alias("bad")))
    h = F.xxhash64("lid", F.lit("quality rules"))
    return (one.withColumn("o", h).orderBy("o", "lid").limit(max_labelled)
            .select("lid", "bad", F.pmod("o", F.lit(3)).cast("int").alias("part")))


def telling_terms(sampled: DataFrame, text_col: str, min_docs: int, min_ratio: float) -> list[str]:
    """Word beginnings that stand in many more bad texts than good ones."""
    terms = F.array_distinct(F.regexp_extract_all(F.lower(text_of(F.col(text_col))), F.lit(TERM_RE), F.lit(0)))
    counts = (sampled.select("bad", F.explode(terms).alias("term"))
              .groupBy("term").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")))
    n = sampled.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0))).first()
    if not n[0] or not n[1]:
        return []
    told = (F.col("b") / n[0]) / ((F.col("g") + 1) / n[1])
    top = counts.filter(F.col("b") >= min_docs).filter(told >= min_ratio).orderBy(F.desc("b"), "term").limit(MAX_TERMS)
    return sorted(r.term for r in top.select("term").collect())


def learn(rows: DataFrame, terms: list[str], max_rules: int = 10, max_conditions: int = 4,
          min_precision: float = 0.95, min_cover: int = 5, bins: int = BINS) -> Rules:
    """Sequential covering over measured rows that also have ``bad`` and ``part``
    (0 and 1 grow, 2 prunes)."""
    names = list(features())
    rows = rows.select("bad", "part", *[c for c in rows.columns if c.startswith("n_") or c == "word_chars"])
    quantiles = [i / bins for i in range(1, bins)]
    edges = rows.agg(*[F.percentile_approx(x, quantiles, 1000).alias(n) for n, x in features().items()]).first()
    if edges is None or edges[names[0]] is None:
        return Rules([], terms)
    edges = {n: sorted({0.0, *edges[n]}) for n in names}
    # a feature's bin is how many edges are below it
    binned = F.array(*[F.struct(F.lit(n).alias("f"), F.size(F.filter(
        F.array(*[F.lit(float(e)) for e in edges[n]]), _below(x))).alias("b")) for n, x in features().items()])
    rules, covered = [], F.lit(False)
    for _ in range(max_rules):
        left = rows.filter(~covered)
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            counts = (left.filter((F.col("part") < 2) & _all(rule)).select("bad", F.explode(binned).alias("x"))
                      .groupBy("x.f", "x.b", "bad").count().collect())  # features x bins x 2 rows at most
            best = _best_condition(counts, edges, min_cover)
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        sums = [F.coalesce(F.sum(F.when(_all(rule[:k]) & (F.col("bad") == v), 1)), F.lit(0)) for k in range(1, len(rule) + 1) for v in (1, 0)]
        held = list(left.filter("part = 2").agg(*sums).first())
        worth = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k, (p, n) in enumerate(zip(held[::2], held[1::2], strict=True), 1)]
        _, k, p, n = max(worth)
        if p < min_cover or p / (p + n) < min_precision:
            break
        rules.append(tuple(rule[:-k]))
        covered = covered | _all(rules[-1])
    return Rules(rules, terms)


def _below(x: Column):
    return lambda e: e < x


def _best_condition(counts, edges: dict[str, list[float]], min_cover: int) -> Condition | None:
    """The threshold condition of most FOIL gain, from counts by feature, bin and label."""
    table: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(e) + 1)] for f, e in edges.items()}
    for r in counts:
        table[r.f][r.b][r.bad] += r["count"]
    some = next(iter(table.values()))
    n0, p0 = (sum(b[v] for b in some) for v in (0, 1))
    if not p0 or not n0:
        return None
    best, gain = None, 1e-9
    for f, by_bin in table.items():
        n = p = 0
        for i, e in enumerate(edges[f]):
            n, p = n + by_bin[i][0], p + by_bin[i][1]
            for above, pos, neg in ((False, p, n), (True, p0 - p, n0 - n)):
                if pos < min_cover:
                    continue
                g = pos * (math.log2(pos / (pos + neg)) - math.log2(p0 / (p0 + n0)))
                if g > gain:
                    best, gain = Condition(f, above, float(e)), g
    return best


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id_col: str = "doc_id", max_labelled: int = MAX_LABELLED,
                  min_term_docs: int = 5, min_term_ratio: float = 8.0) -> tuple[DataFrame, Rules]:
    """All documents with id, ``text_hash``, the statistics, ``base_failed``, ``rule``
    (of the list, null if none holds) and ``kept``; and the list."""
    sample = stage_table(labelled_sample(labels, label_id_col, max_labelled), "labelled")
    mine = F.broadcast(sample)  # max_labelled rows of three numbers at most
    texts = docs.select(F.col(id_col).alias("did"), F.col(text_col).alias("text")).join(mine, F.col("did") == F.col("lid"))
    terms = telling_terms(texts.select("bad", "text"), "text", min_term_docs, min_term_ratio)
    rows = stage_table(measure(docs, id_col, text_col, terms), "measured")
    labelled = stage_table(rows.join(mine, F.col("id") == F.col("lid")).filter(~base_failed()), "labelled-rows")
    rules = learn(labelled, terms)
    out = rows.withColumn("base_failed", base_failed()).withColumn("rule", rules.expression())
    out = out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    return out.withColumnRenamed("id", id_col), rules
