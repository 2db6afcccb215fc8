"""Operator 13: Merkle manifest of a dataset by checkpoint and recompute.

Every row is a leaf: the sha256 of its five columns, each length-prefixed.  The
leaves of a language, in order of their ids, are the lowest level of a binary tree
whose top is the language's subroot; the subroots, in order of the languages, are
those of the tree whose top is the root.  A run of two consecutive nodes, or the
last one alone, becomes the sha256 of its digests.

Only every ``every``-th level is written (:class:`Tree`): nodes meet in aligned
blocks of ``2 ** every`` and a block becomes one node of the next written level.  A
proof walks down the written levels.  At each, the block that holds the node is
read, the levels missing between are computed anew from its nodes, the siblings on
the way are emitted, and the computed levels are dropped again.

Scale: the text is read once, to be hashed; what moves afterwards are rows of ids
and digests.  Positions come from a range partition by (language, id, leaf, row
number), so a language with most rows and ids or rows that repeat are split, and
from a table of counts by partition and language.  A block is the largest group, 16
rows by default.  Languages may be as many as rows: the tree above the subroots is
built the same way.  The driver sees a count and the root.

Defined cases: nulls are ``-``; equal rows are leaves of their own next to each
other; a null language comes first, null ids come first in their language; a lone
leaf is its subroot and a lone subroot the root, with empty proofs; an empty table
gives no rows and no root; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import stage_table

EVERY = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- leaves -----------------------------------------------------------------

def field_text(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    """Digest of a row's five columns, some of them replaced."""
    return F.sha2(F.concat(*[field_text(changed.get(c, F.col(f"`{c}`"))) for c in FIELDS]), 256)


def group_of(lang: Column) -> Column:
    """A language as a key that is never null and sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("-"))


# --- positions --------------------------------------------------------------

def ranked(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """``rows`` (written before) with ``idx``, the place in the row's group ``g`` by
    ``order``, and ``n``, the group's rows."""
    spread = rows.repartitionByRange("g", *order, "salt").sortWithinPartitions("g", *order, "salt").drop("salt")
    # numbers run on inside a partition, where each group's rows are next to each other
    at = F.monotonically_increasing_id()
    spread = stage_table(spread.select("*", at.alias("at")).withColumn("part", F.shiftright("at", 33)), name)
    parts = spread.groupBy("g", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    begins = parts.selectExpr("g", "part", "first", "sum(rows) over (partition by g order by part) - rows as before",
                              "sum(rows) over (partition by g) as n")
    return (spread.join(begins, ["g", "part"])
            .withColumn("idx", F.col("before") + F.col("at") - F.col("first")).drop("part", "at", "first", "before"))


# --- levels -----------------------------------------------------------------

def _above(level: Column) -> Column:
    """The level above one level of a block."""
    at = F.sequence(F.lit(0), F.ceil(F.size(level) / 2).cast("int") - 1)
    return F.transform(at, lambda i: F.sha2(F.concat(level[2 * i], F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256))


def _with_levels(blocks: DataFrame, every: int) -> DataFrame:
    """Blocks with their levels: ``l0`` (the digests), ``l1`` and so on, and how many
    ``steps`` lead to the next written level (fewer at the top of a group)."""
    steps = F.when(F.col("n") > 1 << every, every).when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    out = blocks.withColumn("steps", steps).withColumn("l0", F.col("nodes.digest"))
    for k in range(every):
        here = F.col(f"l{k}")
        out = out.withColumn(f"l{k + 1}", F.when(F.col("steps") > k, _above(here)).otherwise(here))
    return out


def _blocks(nodes: DataFrame, every: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Aligned blocks of nodes in order: ``g``, ``blk``, ``n`` and ``nodes``."""
    entry = F.struct(F.col("idx").bitwiseAND((1 << every) - 1).cast("int").alias("at"), "digest", *carry)
    return (nodes.groupBy("g", F.shiftright("idx", every).alias("blk"))
            .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("nodes")))


@dataclass
class Tree:
    """Written levels of the trees of all groups: nodes ``g, idx, n, digest`` of the
    levels 0, ``every``, 2 * ``every`` and so on; the last has one node a group."""
    levels: list[DataFrame]
    every: int

    @property
    def tops(self) -> DataFrame:
        return self.levels[-1].select("g", F.col("digest").alias("top"))


def build(nodes: DataFrame, every: int, name: str) -> Tree:
    """The trees above the nodes of level 0 (written: ``g, idx, n, digest``, more)."""
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        blocks = _with_levels(_blocks(levels[-1], every), every)
        up = blocks.select("g", F.col("blk").alias("idx"), F.ceil(F.col("n") / (1 << every)).cast("long").alias("n"),
                           F.col(f"l{every}")[0].alias("digest"))
        levels.append(stage_table(up, f"{name}-{len(levels)}"))
        most = -(-most // (1 << every))
    return Tree(levels, every)


# --- proofs -----------------------------------------------------------------

def _siblings(at: Column, every: int) -> Column:
    """What stands left and right of a block's node ``at`` on its way up; the side
    without a sibling is empty."""
    none = F.lit("")

    def step(k: int) -> Column:
        level, i = F.col(f"l{k}"), F.shiftright(at, k)
        odd = i.bitwiseAND(1) == 1
        return F.struct(F.when(odd, F.get(level, i - 1)).otherwise(none).alias("l"),
                        F.when(odd, none).otherwise(F.coalesce(F.get(level, i + 1), none)).alias("r"))
    return F.slice(F.array(*[step(k) for k in range(every)]), F.lit(1), F.col("steps"))


def paths(tree: Tree, tops: DataFrame, carry: tuple[str, ...] = (), wanted: DataFrame | None = None) -> DataFrame:
    """All nodes of level 0 (or those of the ``wanted`` ``g, idx``) with ``path``, the
    siblings up to their top and on along the path of the group in ``tops`` (``g``,
    ``path``, more columns)."""
    every = tree.every
    need = [wanted.select("g", "idx")] if wanted is not None else []
    for _ in tree.levels[1:]:
        need += [need[-1].select("g", F.shiftright("idx", every).alias("idx")).distinct()] if need else []
    out = tops.withColumn("idx", F.lit(0).cast("long"))
    extra = [c for c in tops.columns if c not in ("g", "path")]
    for k in range(len(tree.levels) - 2, -1, -1):
        kept = carry if k == 0 else ()
        blocks = _blocks(tree.levels[k], every, kept)
        blocks = _with_levels(blocks.join(out.select("g", F.col("idx").alias("blk"), "path", *extra), ["g", "blk"]), every)
        node = blocks.select("*", F.explode("nodes").alias("node"))
        out = node.select("g", ((F.col("blk") * (1 << every)) + F.col("node.at")).alias("idx"), F.col("node.digest").alias("digest"),
                          F.concat(_siblings(F.col("node.at"), every), "path").alias("path"), *extra, *[F.col(f"node.{c}") for c in kept])
        if need:
            out = out.join(need[k], ["g", "idx"], "left_semi")
    if len(tree.levels) == 1:  # every group is one node, which is its top
        out = tree.levels[0].select("g", "idx", "digest", *carry).join(out.drop("idx"), "g")
        out = out.join(need[0], ["g", "idx"], "left_semi") if need else out
    return out


def digest_of_path(path: Column) -> Column:
    """sha256 of the siblings, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p.l, p.r)), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(p.l, acc, p.r), 256))


# --- operator ---------------------------------------------------------------

@dataclass
class Manifest:
    """Trees of the languages, the tree of their subroots, and the root."""
    trees: Tree
    above: Tree
    root: str | None

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """All leaves (or those of the ``wanted`` ids): id, ``leaf``, ``changed`` (the
        leaf of the copy to be checked), ``subroot`` and ``path``."""
        top = self.above.levels[-1].select("g", F.array().cast("array<struct<l:string,r:string>>").alias("path"))
        tops = paths(self.above, top, ("lang_g",)).select(F.col("lang_g").alias("g"), F.col("digest").alias("subroot"), "path")
        if wanted is not None:
            wanted = self.trees.levels[0].join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        out = paths(self.trees, tops, ("doc_id", "changed"), wanted)
        return out.select("doc_id", F.col("digest").alias("leaf"), "changed", "subroot", "path")


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, every: int = EVERY) -> Manifest:
    """The manifest of a table with the columns ``FIELDS``.  ``changed`` replaces
    columns in the copy that :meth:`Manifest.proofs` is to check."""
    leaves = docs.select(group_of(F.col("lang")).alias("g"), "doc_id", leaf_of().alias("digest"),
                         (leaf_of(**changed) if changed else leaf_of()).alias("changed"),
                         F.monotonically_increasing_id().alias("salt"))
    leaves = stage_table(ranked(stage_table(leaves, "leaves"), "leaves-sorted", "doc_id", "digest"), "leaves-placed")
    trees = build(leaves, every, "nodes")
    subroots = trees.tops.select(F.lit("").alias("g"), F.col("g").alias("lang_g"), F.col("top").alias("digest"), F.lit(0).alias("salt"))
    above = build(stage_table(ranked(subroots, "subroots-sorted", "lang_g"), "subroots"), every, "subroot-nodes")
    root = above.tops.first()
    return Manifest(trees, above, root.top if root else None)


def tampered(doc_id: Column, n_chars: Column) -> Column:
    """``n_chars`` plus one where 7 divides the crc32 of the decimal id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    return F.when(hit, (n_chars.cast("decimal(20,0)") + 1).cast("decimal(21,0)")).otherwise(n_chars.cast("decimal(21,0)"))


def verify(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """All rows of the untampered table with their proofs, and the roots to which the
    leaves of the tampered copy lead."""
    found = manifest(docs, {"n_chars": tampered(F.col("doc_id"), F.col("n_chars"))}, every)
    out = found.proofs().withColumn("root", F.lit(found.root).cast("string")).withColumn("folded_root", fold(F.col("changed"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", digest_of_path(F.col("path")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
