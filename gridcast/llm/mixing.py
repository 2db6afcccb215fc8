"""Operator 6: mixing sources to target weights by a splitting tree.

Targets.  Sources in code-point order (null last) have cyclic weights and share
the total size by weight; a target stops at ``max_repeat`` times its source's
size and the excess goes to the others by weight until none is above.

Blocks.  A source's documents fall into blocks of about ``block_words`` words by a
keyed hash, and the blocks of a source are put into a permuted order.  A source
takes whole passes over its blocks and then blocks in that order until its target
is met; the last document is cut there, so what is taken from a source is its
rounded target exactly.

Shards.  The block draws of all sources are divided among the output shards by a
tree: each node splits its exact quotas between two halves by a multivariate
hypergeometric draw (one source after the other, inverse distribution function of
a keyed uniform number), down to single shards.  A shard's draws of a source are
then a run of that source's permuted blocks, disjoint from those of all other
shards, and are put in order inside the shard by a keyed hash.

Scale.  A source is never gathered: sums have map-side combines, a running sum
over a source's blocks is made of sums over runs of about ``RUN`` blocks and sums
inside each run, and documents meet only within their block.  The table of
sources (a row each) and the tree's nodes are metadata.

Native DataFrame functions only.  Everything follows from the rows and the seed,
so reruns agree.

Defined cases: a null or wordless text has size zero and is never taken; null is
a source of its own; null ids are kept; equal rows are rows of their own (which
of them is cut is not told apart); an empty table, or one without words, gives
targets of zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import n_words_of, stage_table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 22
#: Blocks in a run of the two-step running sum.
RUN = 1024
#: Standard deviations around the mean in which a draw is looked for; what lies
#: beyond has less than e**-400 of the probability.
SPREAD = 30


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sizes`` (source, source_size) with ``si`` (number in code-point order from 0,
    null last), ``weight`` and ``target``."""
    order = Window.orderBy(F.asc_nulls_last("source"))  # a row per source
    s = sizes.withColumn("si", F.row_number().over(order) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("si", F.lit(len(weights))) + 1))
    s = s.withColumn("cap", (max_repeat * F.col("source_size")).cast("double"))
    # in the order in which they reach their caps: the level if all before are at theirs
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "si")
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "si", "level"))
    s = s.withColumn("first_free", F.min(free).over(everything))
    level = F.col("first_free.level")
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return s.select("source", "si", "source_size", "weight", target.alias("target"))


def _uniform(*key) -> Column:
    """Keyed uniform number in [0, 1) of 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))


def hypergeometric(n_all: Column, n_good: Column, n_draw: Column, u: Column) -> Column:
    """How many good ones a draw of ``n_draw`` out of ``n_all`` without replacement
    has, by the inverse distribution function at ``u``; all whole doubles."""
    share = F.coalesce(F.try_divide(n_good, n_all), F.lit(0.0))
    mean = n_draw * share
    sd = F.sqrt(F.greatest(mean * (1 - share) * F.coalesce(F.try_divide(n_all - n_draw, n_all - 1), F.lit(0.0)), F.lit(0.0)))
    lo = F.greatest(F.lit(0.0), n_draw + n_good - n_all, F.floor(mean - SPREAD * sd).cast("double") - 8)
    hi = F.least(n_draw, n_good, F.ceil(mean + SPREAD * sd).cast("double") + 8)
    steps = F.when(lo < hi, F.sequence((lo + 1).cast("long"), hi.cast("long"))).otherwise(F.array().cast("array<long>"))

    def ratio(k: Column) -> Column:  # of the probabilities of k and k - 1
        return (n_good - k + 1) * (n_draw - k + 1) / (k * (n_all - n_good - n_draw + k))

    one = F.lit(1.0)
    total = F.aggregate(steps, F.struct(one.alias("w"), one.alias("sum")), lambda a, k: F.struct(
        (a.w * ratio(k)).alias("w"), (a.sum + a.w * ratio(k)).alias("sum")), lambda a: a.sum)
    return F.aggregate(steps, F.struct(one.alias("w"), (u * total - 1.0).alias("left"), lo.alias("pick")), lambda a, k: F.struct(
        (a.w * ratio(k)).alias("w"), (a.left - a.w * ratio(k)).alias("left"),
        F.when(a.left > 0, k.cast("double")).otherwise(a.pick).alias("pick")), lambda a: a.pick)


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(si, draws) divided among shards: (si, shard, first, n), where a shard has the
    draws ``first`` to ``first + n - 1`` of the source."""
    part = F.struct("si", F.col("draws").cast("double").alias("n"), F.lit(0.0).alias("first"))
    nodes = (quotas.filter("draws > 0").agg(F.array_sort(F.collect_list(part)).alias("parts"))  # a row per source
             .select(F.lit(0).cast("long").alias("lo"), F.lit(n_shards).cast("long").alias("hi"), "parts"))
    levels = max(0, (n_shards - 1).bit_length())
    for level in range(levels):
        if level and level % 6 == 0:
            nodes = nodes.repartition("lo")  # the lower part of the tree on many tasks
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        total = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p.n)
        nodes = nodes.select("lo", "hi", "parts", mid.alias("mid"), total.alias("total"))
        start = F.struct(F.col("total").alias("all"), F.round(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("room"),
                         F.array().cast("array<double>").alias("left"))

        def draw(a: Column, p: Column) -> Column:
            x = hypergeometric(a.all, p.n, a.room, _uniform(F.lit(seed), F.col("lo"), F.col("hi"), p.si))
            return F.transform(F.array(x), lambda v: F.struct(  # x is drawn once
                (a.all - p.n).alias("all"), (a.room - v).alias("room"), F.array_append(a.left, v).alias("left")))[0]

        nodes = nodes.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, F.aggregate("parts", start, draw, lambda a: a.left)))
        halves = F.when(F.col("left").isNull(), F.array(F.struct("lo", "hi", "parts"))).otherwise(F.array(
            F.struct("lo", F.col("mid").alias("hi"), F.zip_with("parts", "left", lambda p, x: F.struct(
                p.si.alias("si"), x.alias("n"), p["first"].alias("first"))).alias("parts")),
            F.struct(F.col("mid").alias("lo"), "hi", F.zip_with("parts", "left", lambda p, x: F.struct(
                p.si.alias("si"), (p.n - x).alias("n"), (p["first"] + x).alias("first"))).alias("parts"))))
        nodes = nodes.select(F.explode(halves).alias("h")).select("h.*")
    leaf = nodes.select(F.col("lo").alias("shard"), F.explode("parts").alias("p"))
    return leaf.select("p.si", "shard", F.col("p.first").cast("long").alias("first"), F.col("p.n").cast("long").alias("n")).filter("n > 0")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = 6, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: id, the ``carry`` columns (as struct ``doc``), source,
    ``size``, ``source_size``, ``target``, ``taken`` and ``draws``: an array of (pass,
    shard, words, place), ``place`` ordering the draws inside a shard."""
    kept = [F.struct(*carry).alias("doc")] if carry else []
    rows = stage_table(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words_of(F.col(text_col)).alias("size"),
                                   F.xxhash64(F.lit(seed), id_col, text_col).alias("key"), *kept), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    words = F.round("target").cast("long")
    n_blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"))
    passes = F.coalesce(F.try_divide(words, F.col("source_size")).cast("long"), F.lit(0).cast("long"))
    s = targets.withColumn("n_blocks", n_blocks).withColumn("passes", passes)
    s = stage_table(s.withColumn("rest", words - F.col("passes") * F.col("source_size")).withColumn("words", words), "mix-sources")

    # no source's rows meet: the table of sources is small, or else the join splits hot keys
    mine = s.select(F.col("source").alias("s"), "si", "n_blocks")
    placed = (rows.filter("size > 0").join(mine, F.col("source").eqNullSafe(F.col("s")))
              .withColumn("block", F.pmod("key", "n_blocks")))
    blocks = placed.groupBy("si", "block", "n_blocks").agg(F.sum("size").alias("block_size"))
    blocks = blocks.withColumn("u", F.xxhash64(F.lit(seed), F.lit("order"), "si", "block"))
    blocks = stage_table(blocks.withColumn("run", F.pmod(F.shiftright("u", 20), F.ceil(F.col("n_blocks") / F.lit(RUN)).cast("long"))), "mix-blocks")
    by_run = Window.partitionBy("si").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = (blocks.groupBy("si", "run").agg(F.count("*").alias("k"), F.sum("block_size").alias("w"))
            .select("si", "run", F.coalesce(F.sum("k").over(by_run), zero).alias("run_rank"), F.coalesce(F.sum("w").over(by_run), zero).alias("run_words")))
    in_run = Window.partitionBy("si", "run").orderBy("u", "block").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (blocks.join(runs, ["si", "run"])
              .withColumn("rank", F.col("run_rank") + F.coalesce(F.count("*").over(in_run), zero))
              .withColumn("before", F.col("run_words") + F.coalesce(F.sum("block_size").over(in_run), zero)))
    full = s.select(F.col("si").alias("s2"), "passes", "rest", "words")
    part = F.greatest(zero, F.least(F.col("rest") - F.col("before"), F.col("block_size")))
    ranked = ranked.join(full, F.col("si") == F.col("s2")).withColumn("part", part)
    # draws of a source are numbered pass by pass in the permuted order; blocks that
    # hold words are counted, not the hash buckets
    counts = (ranked.groupBy("si").agg(F.count("*").alias("filled"), F.count(F.when(F.col("part") > 0, 1)).alias("begun"), F.first("passes").alias("passes"))
              .select("si", "filled", (F.col("passes") * F.col("filled") + F.col("begun")).alias("draws")))
    counts = stage_table(counts, "mix-quotas")
    all_words = s.agg(F.coalesce(F.sum("words"), zero)).first()[0]
    shards = split_quotas(counts, max(1, -(-all_words // shard_words)), seed)
    slots = shards.select(F.col("si").alias("dsi"), "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("dj"))
    each = (ranked.join(counts.select(F.col("si").alias("csi"), "filled"), F.col("si") == F.col("csi"))
            .select("si", "block", "filled", "rank", "block_size", "part", F.explode(F.sequence(zero, F.col("passes"))).alias("pass"), "passes")
            .select("si", "block", "pass", (F.col("pass") * F.col("filled") + F.col("rank")).alias("j"),
                    F.when(F.col("pass") < F.col("passes"), F.col("block_size")).otherwise(F.col("part")).alias("part"))
            .filter("part > 0"))
    drawn = each.join(slots, (F.col("si") == F.col("dsi")) & (F.col("j") == F.col("dj")))
    by_block = (drawn.groupBy("si", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "part"))).alias("list"))  # max_repeat + 1 at most
                .select(F.col("si").alias("bsi"), F.col("block").alias("bb"), "list"))
    in_block = Window.partitionBy("si", "block").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = placed.withColumn("at", F.coalesce(F.sum("size").over(in_block), zero))
    got = cut.join(by_block, (F.col("si") == F.col("bsi")) & (F.col("block") == F.col("bb")), "left")
    draws = F.filter(F.transform("list", lambda d: F.struct(
        d["pass"].alias("pass"), d.shard.alias("shard"), F.greatest(zero, F.least(d.part - F.col("at"), F.col("size"))).alias("words"),
        F.xxhash64(F.lit(seed), d.shard, F.col("key"), d["pass"]).alias("place"))), lambda d: d.words > 0)
    none = F.array().cast("array<struct<pass:bigint,shard:bigint,words:bigint,place:bigint>>")
    columns = ["id", "source", "size", *(["doc"] if carry else [])]
    got = got.select(*columns, F.coalesce(draws, none).alias("draws"))
    out = got.unionByName(rows.filter("size = 0").select(*columns, none.alias("draws")))
    ends = s.select(F.col("source").alias("s3"), "source_size", "target")
    out = out.join(ends, F.col("source").eqNullSafe(F.col("s3")))
    return out.select(F.col("id").alias(id_col), *columns[1:], "source_size", "target",
                      F.aggregate("draws", zero, lambda a, d: a + d.words).alias("taken"), "draws")
