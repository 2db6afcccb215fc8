"""Operator 11: best-two-fit packing of documents into training sequences.

A document is its byte-level BPE ids and an end mark.  Documents longer than a
sequence are cut into whole sequences, of which only the first may be shorter; all
others stay in one piece.  A sequence is filled greedily with the longest pieces
that fit, and then its smallest piece is replaced by the two unpacked ones that fill
the gap so expanded most tightly, if they fill more of it.

Which pieces go together depends on their lengths alone, of which there are at most
``size``.  The sequences are therefore planned on the counts of the lengths: the same
choice is made again until a length it uses runs short, so one step of the plan
stands for all the sequences that are alike, and the plan is that of the whole table
packed one sequence at a time.  A step uses up a length or leaves less of it
than a sequence holds, which bounds the plan (some ``size * ln(size)`` steps) however
many documents there are.

Scale: the texts are read once; each task numbers its pieces by length as it goes and
writes narrow rows (ids and lengths, the tokens only if asked for).  The counts by
task and length, summed up in task order, turn these numbers into the rank of a piece
among all of its length, and the plan turns the rank into a sequence and an offset.
No row meets another, so a length that most pieces have is no hot key.  The driver
holds one count a length, and the plan.

Defined cases: a null or empty text is one piece with only the end mark; equal rows
are packed each; null ids are kept; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import stage_table
from gridcast.llm.training_order import slices

SIZE = 1024
END = 2
LONG = 1 << 20
#: Beyond these characters two libraries might not agree on what is a letter.
LATIN = re.compile(r"[\x00-\u036f\u2010-\u2027]*")
INSIDE = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


# --- tokens -----------------------------------------------------------------

class Encoder:
    """Ids as the ``tokenizers`` library gives them.  Latin texts go through ``tiktoken``
    with the file's own vocabulary, which gives the same ids in a quarter of the
    time."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        merged = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        if sorted(ranks.values()) != list(range(len(ranks))) or any(
                spec["model"]["vocab"][a + b] != 256 + k for k, (a, b) in enumerate(merged)):
            raise ValueError("the ids of merges must be their ranks")
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> list[int]:
        if len(text) <= LONG:
            return self._ids(text)
        out, at = [], 0
        while at < len(text):  # a pre-token begins with a space between two letters
            stop = INSIDE.search(text, at + LONG)
            stop = stop.start() if stop else len(text)
            out += self._ids(text[at:stop])
            at = stop
        return out

    def _ids(self, text: str) -> list[int]:
        if LATIN.fullmatch(text):
            return self.fast.encode(text, allowed_special="all")
        return self.whole.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids."""
    first = n - (n - 1) // size * size
    return [(0, first), *[(at, size) for at in range(first, n, size)]]


# --- plan -------------------------------------------------------------------

def best_two(lengths: np.ndarray, left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two lengths (of ``lengths``, ascending, all left) of the largest sum within
    ``room``."""
    a = lengths[lengths < room]
    if not len(a):
        return None
    at = np.searchsorted(lengths, room - a, side="right") - 1
    # a length that only one piece has cannot be taken twice
    alone = np.fromiter((left[x] < 2 for x in a.tolist()), bool, len(a))
    at = at - ((at >= 0) & (lengths[at] == a) & alone)
    total = np.where(at >= 0, a + lengths[at], 0)
    k = int(np.argmax(total))
    return (int(a[k]), int(lengths[at[k]])) if total[k] else None


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Steps of the plan: the lengths of a sequence, and how many are alike."""
    left = {n: c for n, c in counts.items() if c}
    steps = []
    while left:
        have = sorted(left)
        used: dict[int, int] = {}
        chosen, gap = [], size
        while (k := bisect_right(have, gap)) > 0:
            n = have[k - 1]
            chosen.append(n)
            gap -= n
            used[n] = used.get(n, 0) + 1
            if used[n] == left[n]:
                have.pop(k - 1)
        if gap:
            small = chosen[-1]
            spare = {n: left[n] - used.get(n, 0) + (n == small) for n in {*have, small}}
            two = best_two(np.array(sorted(spare)), spare, gap + small)
            if two and sum(two) > small:
                chosen[-1:] = sorted(two, reverse=True)
        used = {n: chosen.count(n) for n in set(chosen)}
        times = min(left[n] // k for n, k in used.items())
        steps.append((chosen, times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return steps


class Places:
    """Sequence and offset of the piece of each rank among the pieces of its length."""

    def __init__(self, steps: list[tuple[list[int], int]]):
        next_rank: dict[int, int] = {}
        rows, sequence = [], 0
        for chosen, times in steps:
            offset = 0
            for n in chosen:
                rows.append((n, next_rank.get(n, 0), sequence, offset))
                next_rank[n] = next_rank.get(n, 0) + times
                offset += n
            sequence += times
        self.length, self.rank, self.sequence, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 4).T
        self.n_sequences = sequence
        self.first = {int(n): int(k) for n, k in zip(*np.unique(self.length, return_index=True), strict=True)}

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for n in np.unique(length).tolist():
            mine = np.flatnonzero(length == n)
            begin = self.first[n]
            end = begin + int(np.searchsorted(self.length[begin:], n, side="right"))
            at[mine] = begin + np.searchsorted(self.rank[begin:end], rank[mine], side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


# --- operator ---------------------------------------------------------------

def _pieces(path: str, size: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), np.zeros(size + 1, np.int64)
        for b in batches:
            for i, j in slices(b.column(2)):
                doc, rows = [], []
                for d, text in enumerate(b.column(2).slice(i, j - i).to_pylist()):
                    ids = np.array([*encode(text or ""), end], "<u4")
                    for piece, (at, n) in enumerate(pieces_of(len(ids), size)):
                        raw = ids[at:at + n].tobytes()
                        doc.append(i + d)
                        rows.append((piece, at, n, zlib.crc32(raw), int(seen[n]), raw if with_ids else None))
                        seen[n] += 1
                piece, at, n, crc, nth, raw = zip(*rows, strict=True)
                take = pa.array(doc)
                cols = [b.column(0).take(take), b.column(1).take(take), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (at, n, crc, nth)]]
                names = ["part", "id", "piece", "start", "length", "ids_crc32", "nth"]
                if with_ids:
                    cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and, if asked for, ``ids`` (little-endian 32-bit)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"part int, id {id_type}, piece int, start long, length long, ids_crc32 long, nth long{', ids binary' if with_ids else ''}"
    rows = stage_table(rows.mapInArrow(_pieces(tokenizer_path, size, end, with_ids), schema), "pieces", "zstd" if with_ids else "snappy")

    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = stage_table(counts.selectExpr("part", "length", "n", "sum(n) over (partition by length order by part) - n as before"), "lengths")
    # at most ``size`` rows, whatever the documents
    places = Places(plan(dict(map(tuple, counts.groupBy("length").agg(F.sum("n")).collect())), size))
    ranks = rows.join(counts.drop("n"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth")).drop("part", "before", "nth")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places(b.column("length").to_numpy(), b.column("rank").to_numpy())
            kept = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in ranks.schema if f.name != "rank"]
    out = ranks.mapInArrow(place, ", ".join([*kept, "sequence_id long", "offset long"]))
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences of pieces packed ``with_ids``: ``sequence_id``, ``n_tokens``,
    ``offsets`` where its pieces begin, and ``ids``; a group has at most ``size`` rows."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(pieces.alias("p"))
    ids = F.unhex(F.array_join(F.transform("p.ids", F.hex), ""))
    return rows.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
                       F.col("p.offset").alias("offsets"), ids.alias("ids"))
