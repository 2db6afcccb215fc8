"""Operator 10: SimHash near-duplicates through BK-trees.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles.
``link_components`` links distinct fingerprints at ``radius`` or fewer differing
bits and closes the links transitively.

Shards.  The 64 bits are cut into ``agree + radius`` blocks.  Two fingerprints
within the radius spoil at most ``radius`` blocks, so they share at least
``agree`` whole blocks: every choice of ``agree`` blocks is one table, and the
fingerprints that have equal bits there form one shard.  No link is lost
whatever ``agree`` is; it follows from the number of distinct fingerprints, so
that a shard holds few at any size.  Each shard is a BK-tree (children keyed by
integer Hamming distance to the parent) whose members are searched against it,
following only edges within the radius; a batch of shards is built and searched
level by level in numpy.

A shard above ``shard_cap`` fingerprints is split into pieces, and each piece's
tree also goes to every other piece of the shard, so no task ever holds more
than two pieces.  A shard emits at most one link per member (to the smallest
fingerprint it is connected with), never all pairs.  The links are closed by
alternating star contraction on the cluster.

Defined cases: a null, empty or blank text has fingerprint zero and is linked
like any other; equal rows share fingerprint and component; a null id takes part
and never is a component's name while an id is there; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import stage_table

SHINGLE_WORDS = 4
RADIUS = 4
#: A key of more than this part of the rows is looked up in a broadcast table.
HOT = 1000
SEED = 42
#: Most fingerprints in one piece of a shard.
SHARD_CAP = 8192
#: Fingerprints that a shard is meant to hold; sets how many blocks must agree.
SHARD_LOAD = 64
#: Most (query, node) visits held at a time while a batch of trees is searched.
VISITS = 2_000_000


# --- fingerprints -----------------------------------------------------------

def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    joined = memoryview(b" ".join(words))
    k = min(shingle_words, n)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    begins = (ends - lens)[:n - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    digest, total, m = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(begins)
    for at in range(0, m, 65536):  # bounded memory for very long texts
        part = np.fromiter((digest(joined[a:b], seed) for a, b in
                            zip(begins[at:at + 65536], ends[at:at + 65536], strict=True)), "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > m, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash as a signed long (the same 64 bits)."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.fromiter((simhash(t, shingle_words) for t in s), np.uint64,
                                        len(s)).view(np.int64))
    return of(text)


def hex_of(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- BK-trees ---------------------------------------------------------------

def build_forest(fps: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over all shards at once; the fingerprints of a shard are distinct
    and lie together.

    Returns the root of each row, and the child slots as sorted keys
    ``parent * 65 + distance`` with the child that hangs there.
    """
    n = len(fps)
    first = np.r_[True, shard[1:] != shard[:-1]] if n else np.zeros(0, bool)
    roots = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)
    at, cur = np.flatnonzero(~first), roots[~first]
    keys, children = [], []
    while len(at):
        slot = cur * 65 + np.bitwise_count(fps[at] ^ fps[cur])
        taken, head, of = np.unique(slot, return_index=True, return_inverse=True)
        keys.append(taken)
        children.append(at[head])  # the first row that comes to an empty slot stays there
        left = np.ones(len(at), bool)
        left[head] = False
        at, cur = at[left], at[head][of[left]]
    if not keys:
        return roots, np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return roots, key[order], child[order]


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; every label ends at its class's least row."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def forest_classes(fps: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """For each row the least row that it is connected with inside its shard."""
    roots, key, child = build_forest(fps, shard)
    n = len(fps)
    label = np.arange(n)
    sizes = np.bincount(roots, minlength=n)[roots] if n else roots
    # as many queries at a time as keep the visits bounded
    blocks = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + VISITS, VISITS)) if n else []
    for lo, hi in zip(blocks[:-1], np.r_[blocks[1:-1], n], strict=True) if n else ():
        q, node = np.arange(lo, hi), roots[lo:hi]
        while len(q):
            d = np.bitwise_count(fps[q] ^ fps[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            _hook(label, q[near], node[near])
            start = np.searchsorted(key, node * 65 + np.maximum(d - radius, 0))
            stop = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), side="right")
            many = stop - start
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            q, node = np.repeat(q, many), child[np.repeat(start, many) + within]
    return label


def _shard_links(radius: int):
    """mapInArrow over rows sorted by shard: (fp, least connected fp) where they differ."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        keys = ("t", "bits", "lo", "hi", "fp")

        def out(cols):
            change = np.zeros(len(cols[0]), bool)
            change[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
            fps = cols[4].view(np.uint64)
            label = forest_classes(fps, np.cumsum(change), radius)
            moved = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[4][moved]), pa.array(cols[4][label[moved]])], names=["u", "v"])

        for b in batches:
            cols = tuple(b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys)
            if not len(cols[0]):
                continue
            held.append(cols)
            last = tuple(c[-1] for c in cols[:4])
            if all(c[0] == x for c, x in zip(held[0][:4], last, strict=True)):
                continue  # one shard so far, of two pieces at most
            cols = tuple(np.concatenate(c) for c in zip(*held, strict=True))
            cut = int(np.flatnonzero(np.any([c != x for c, x in zip(cols[:4], last, strict=True)], axis=0))[-1]) + 1
            held = [tuple(c[cut:] for c in cols)]
            yield out(tuple(c[:cut] for c in cols))
        if held:
            yield out(tuple(np.concatenate(c) for c in zip(*held, strict=True)))
    return links


# --- components -------------------------------------------------------------

def agree_for(n: int, radius: int = RADIUS, load: int = SHARD_LOAD) -> int:
    """How many blocks must agree so that a shard of ``n`` even fingerprints holds about ``load``."""
    agree = 1
    while n >> (64 * agree // (agree + radius)) > load and agree < 8:
        agree += 1
    return agree


def masks_of(agree: int, radius: int = RADIUS) -> list[int]:
    """The bits that must be equal, one mask (as a signed long) for each choice of blocks."""
    cuts = [64 * i // (agree + radius) for i in range(agree + radius + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [int(np.array(sum(c), np.uint64).view(np.int64)) for c in combinations(blocks, agree)]


def fingerprint_links(nodes: DataFrame, radius: int = RADIUS, shard_cap: int = SHARD_CAP,
                      agree: int | None = None) -> DataFrame:
    """Links (u, v), u > v unsigned order not implied, that connect what lies within
    the radius: a star in each shard.  ``nodes`` has distinct ``fp``."""
    masks = masks_of(agree or agree_for(nodes.count(), radius), radius)
    members = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "bits"))
    sizes = members.groupBy("t", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    pieces = sizes.withColumn("pieces", F.ceil(F.col("n") / F.lit(shard_cap)).cast("long")).drop("n")
    own = F.pmod(F.xxhash64("fp"), F.col("pieces"))
    # every piece of a split shard meets every other one
    placed = (members.join(pieces, ["t", "bits"])
              .select("t", "bits", "fp", own.alias("own"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other"))
              .select("t", "bits", F.least("own", "other").alias("lo"),
                      F.greatest("own", "other").alias("hi"), "fp"))
    sorted_ = (placed.repartition("t", "bits", "lo", "hi")
               .sortWithinPartitions("t", "bits", "lo", "hi", "fp"))
    return sorted_.mapInArrow(_shard_links(radius), "u long, v long").distinct()


def close_links(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of links (u, v) by alternating large and small stars.

    Returns (u, root) for every node but the roots; a root is the least node of
    its component.  Each half round keeps connectivity, moves links towards the
    least neighbour, and costs one aggregate and one join.
    """
    def digest(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    links = stage_table(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = digest(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u <> v").distinct())
        links = stage_table(small, "links")
        after = digest(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links not closed after {max_rounds} rounds")
    return links.select("u", F.col("v").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                       shard_cap: int = SHARD_CAP, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (long), ``root`` (the component's
    least fingerprint), ``component_id`` (its least id), and the ``carry`` columns."""
    rows = stage_table(docs.select(id_col, *carry, fingerprint(F.col(text_col), shingle_words).alias("fp")), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("least_id"), F.count("*").alias("copies"))
    stars = close_links(fingerprint_links(nodes.select("fp"), radius, shard_cap))
    below = stage_table(nodes.join(stars, nodes.fp == stars.u).select("fp", "least_id", "copies", "root"), "below-roots")
    # few rows per root after the map-side combine, whatever its group's size
    least = below.groupBy("root").agg(F.min("least_id").alias("m"), F.count("*").alias("n"))
    # every node that is not below a root is one; F.least skips a null id
    roots = stage_table(nodes.join(below.select("fp"), "fp", "left_anti").join(least, F.col("fp") == F.col("root"), "left")
                        .select(F.col("fp").alias("root"), "copies", F.least("least_id", "m").alias("component_id"), "n"), "roots")
    named = _looked_up(below.drop("least_id"), roots.filter("n is not null").drop("copies"), "root", below.count())
    classes = roots.select(F.col("root").alias("fp"), "root", F.col("copies").alias("n"), "component_id").unionByName(
        named.select("fp", "root", F.col("copies").alias("n"), "component_id"))
    return _looked_up(rows, classes, "fp", rows.count()).select(id_col, *carry, "fp", "root", "component_id")


def _looked_up(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) with the columns of ``table``, which has each key once
    and in ``n`` how many rows have it.  Keys of more than a ``HOT``-th of the rows, fewer
    than ``HOT`` by that, are broadcast, so no task gets more of one key than that."""
    hot = F.col("n") > F.lit(total / HOT)
    few = F.broadcast(table.filter(hot).drop("n"))
    others = rows.join(few.select(key), key, "left_anti").join(table.filter(~hot).drop("n"), key)
    return rows.join(few, key).unionByName(others)
