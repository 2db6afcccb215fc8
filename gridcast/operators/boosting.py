"""Gradient-boosted trees on histograms, for several targets of one table at once
(the trainer behind M3-M5).

The feature columns are cut into at most ``bins`` quantile bins once; from then on a
row is one byte a feature, its labels and a hash.  Trees grow level by level: every
task sums first and second derivatives by (node, feature, bin), the sums of all tasks
meet by node, the best split of a node follows from its sums alone, and the splits go
back with the next job.  The objective is second-order with an L2 term on the
leaves and a least hessian a child, log loss for a class and squared error for a
number.

Where things are.  The binned rows are a written table.  The driver holds the trees (some
kilobytes a round) and sends them with each job; where a block of rows is worked on its
predictions are kept and brought up to date with the trees that they miss, so a new worker or a
lost executor only has more trees to apply.  Where one task holds all rows of a target its
sums are complete, so it goes on to the next level itself, ``ROUNDS_A_JOB`` rounds in a job.
More rows are dealt to all cores.  A block then lies in its executor's scratch folder, by
column and mapped by whichever worker has the task (``Placed``), so a level is a job of one stage
that moves sums alone, of the smaller child of each node: the driver takes them from
their parents' for the other.  Sums of a level on the driver are nodes x features x bins, whatever the rows.

Derivatives are whole multiples of 1 / 2**20 and sums of them are exact, rows are
sampled by their hash and a round's number, and ties go to the first feature
and bin.  So the trees follow from the rows and bin edges, not from partitions, order
or retries.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import materialize

BINS = 64
#: A task works on one block at a time, in some 250 bytes a row.
ROWS_A_BLOCK = 1_000_000
#: Rows that fill more than one block are dealt to all cores, but so many to each at least.
LEAST_ROWS = 200_000
#: The sums of so many blocks go to the driver as they are; those of more meet by node first.
BLOCKS_GATHERED = 32
#: Jobs in a row that may find blocks gone before the fit gives up.
LOST_JOBS = 10
ROWS_A_CHUNK = 1 << 18
#: Rows that go down a tree together, and the levels at which they meet all nodes.
ROWS_A_WALK, WIDE_LEVELS = 1 << 14, 8
#: Rounds of a job whose task has all rows of a target, and how many trees go along with a
#: job before they are broadcast.
ROUNDS_A_JOB, TREES_ALONG = 100, 25
UNIT = float(1 << 20)
NO_SPLIT = 255


@dataclass(frozen=True)
class Target:
    """A label to be learned: ``log`` loss for a 0/1 label, else ``squared``."""
    name: str
    label: str
    loss: str = "squared"


@dataclass(frozen=True)
class Settings:
    rounds: int = 500
    depth: int = 6
    rate: float = 0.1
    subsample: float = 0.8
    seed: int = 42
    l2: float = 1.0
    least_hessian: float = 1.0
    bins: int = BINS


@dataclass
class Forest:
    """The trees of one target, each complete: a node that is not split sends all rows
    left.  ``feature``, ``cut`` and ``gain`` by (tree, inner node), ``leaf`` by (tree, leaf)."""
    base: float
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    leaf: np.ndarray

    @staticmethod
    def empty(base: float, depth: int) -> Forest:
        inner, leaves = (1 << depth) - 1, 1 << depth
        return Forest(base, np.zeros((0, inner), np.int16), np.zeros((0, inner), np.uint8), np.zeros((0, inner)), np.zeros((0, leaves)))

    def __len__(self) -> int:
        return len(self.leaf)

    def part(self, begin: int, end: int | None = None) -> Forest:
        return Forest(self.base, self.feature[begin:end], self.cut[begin:end], self.gain[begin:end], self.leaf[begin:end])

    def plus(self, other: Forest) -> Forest:
        return Forest(self.base, *[np.concatenate([getattr(self, k), getattr(other, k)]) for k in ("feature", "cut", "gain", "leaf")])

    def add_to(self, margin: np.ndarray, bins: np.ndarray) -> None:
        """Add the trees to the predictions of binned rows, one after the other."""
        depth = self.leaf.shape[1].bit_length() - 1
        for begin in range(0, len(bins) if len(self) else 0, ROWS_A_WALK):
            part = slice(begin, begin + ROWS_A_WALK)
            columns, sums_ = np.ascontiguousarray(bins[part].T), margin[part]
            for k in range(len(self)):
                sums_ += np.take(self.leaf[k], _down(columns, None, self.feature[k], self.cut[k], 0, depth))


def _down(columns: np.ndarray, node: np.ndarray | None, feature: np.ndarray, cut: np.ndarray, begin: int, end: int) -> np.ndarray:
    """From nodes of level ``begin`` to those of level ``end``, for rows whose bins come by
    column.  All nodes of a level are compared with all rows, column by column, and a
    row's own is then chosen by the bits of its node: bytes in a row, no look-up a row."""
    kind = np.uint8 if end <= WIDE_LEVELS else np.int64
    node = np.zeros(columns.shape[1], kind) if node is None else node.astype(kind, copy=False)
    for level in range(begin, end):
        first = (1 << level) - 1
        if level >= WIDE_LEVELS:
            at = node + first
            node = 2 * node + (columns[feature[at], np.arange(len(node))] > cut[at])
            continue
        right = (columns[feature[first:2 * first + 1]] > cut[first:2 * first + 1, None]).view(np.uint8)
        for k in range(level - 1, -1, -1):
            half = len(right) >> 1
            right = right[:half] ^ ((right[:half] ^ right[half:]) & (node >> k & 1).astype(np.uint8, copy=False))
        node = node + node + right[0]
    return node


def descend(bins: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Nodes at level ``end``, counted from the left, of rows at nodes of level ``begin``."""
    out, by_column = np.empty(len(bins), np.uint8 if end <= WIDE_LEVELS else np.int64), bins.flags.f_contiguous
    for at in range(0, len(bins), ROWS_A_WALK):
        part = slice(at, at + ROWS_A_WALK)
        columns = bins[part].T if by_column else np.ascontiguousarray(bins[part].T)
        out[part] = _down(columns, node[part], feature, cut, begin, end)
    return out


def walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row ``depth`` levels below the root, counted from the left."""
    return descend(bins, np.zeros(len(bins), np.int64), feature, cut, 0, depth)


# --- sums and splits --------------------------------------------------------

def derivatives(target: Target, margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if target.loss == "log":
        p = 1 / (1 + np.exp(-margin))
        g, h = p - label, p * (1 - p)
    else:
        g, h = margin - label, np.ones(len(margin))
    return np.rint(g * UNIT), np.maximum(np.rint(h * UNIT), 1)


def sampled(key: np.ndarray, round_: int, settings: Settings) -> np.ndarray:
    """Which rows a round sees: a keyed mixing of each row's hash."""
    with np.errstate(over="ignore"):
        x = key ^ np.uint64((settings.seed * 0x9E3779B97F4A7C15 + round_ * 0xD1B54A32D192ED03) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(np.float64) < settings.subsample * (1 << 53)


@dataclass
class Columns:
    """Some rows (``at``; None: all) by column: the bins of each feature, and those of each
    two neighbours as one number, which a block works out once for all rounds."""
    one: np.ndarray
    two: np.ndarray
    at: np.ndarray | None = None

    @staticmethod
    def of(bins: np.ndarray, width: int) -> Columns:
        one = np.ascontiguousarray(bins.T)
        return Columns(one, one[:-1:2] * np.uint16(width) + one[1::2])

    def __len__(self) -> int:
        return self.one.shape[1] if self.at is None else len(self.at)

    def get(self, f: int, both: bool, part: slice) -> np.ndarray:
        column = self.two[f // 2] if both else self.one[f]
        return column[part] if self.at is None else np.take(column, self.at[part], mode="clip")


def sums(bins: np.ndarray | Columns, node: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """First and second derivatives by node, feature and bin (whole numbers).  Features
    are counted two at a time where rows are many enough for the bins of both."""
    rows = bins if isinstance(bins, Columns) else Columns.of(bins, width)
    features, step = len(rows.one), 2 if nodes * width * width <= len(rows) else 1
    out, ones = np.zeros((features, 2, nodes, width), np.int64), np.ones(width)
    for begin in range(0, len(rows), ROWS_A_CHUNK):
        part = slice(begin, begin + ROWS_A_CHUNK)
        at, whole = np.empty(len(node[part]), np.int64), node[part].astype(np.int64)
        first = [whole * width ** k for k in range(1, step + 1)]
        weights = g[part], h[part]
        alike = (weights[1] == weights[1][0]).all()   # squared error: a count says it all
        for f in range(0, features, step):
            both = step == 2 and f + 1 < features
            if nodes == 1:
                np.copyto(at, rows.get(f, both, part))
            else:
                np.add(first[both], rows.get(f, both, part), out=at)
            for k, w in enumerate((weights[0], None if alike else weights[1])):
                found, times = np.bincount(at, w, nodes * width ** (1 + both)), int(weights[1][0]) if k and alike else 1
                if both:   # whole numbers below 2**53 add up exactly in any order
                    found = found.astype(np.float64, copy=False).reshape(nodes, width, width)
                    out[f, k] += (found @ ones).astype(np.int64) * times
                    out[f + 1, k] += (ones @ found).astype(np.int64) * times
                else:
                    out[f, k] += found.reshape(nodes, width).astype(np.int64, copy=False) * times
    return out.transpose(2, 0, 3, 1)


def best_split(total: np.ndarray, settings: Settings) -> tuple[int, int, float, float, float]:
    """Feature, cut, gain and the two children's leaf values for one node's sums."""
    left = np.cumsum(total, axis=1) / UNIT
    whole = left[0, -1]
    right = whole - left
    score = [s[..., 0] ** 2 / (s[..., 1] + settings.l2) for s in (left, right, whole)]
    gain = score[0] + score[1] - score[2]
    gain[(left[..., 1] < settings.least_hessian) | (right[..., 1] < settings.least_hessian)] = -np.inf
    at = int(np.argmax(gain))
    feature, cut = divmod(at, gain.shape[1])

    def leaf(s):
        return float(-s[0] / (s[1] + settings.l2) * settings.rate)
    if gain[feature, cut] <= 1e-6:
        return 0, NO_SPLIT, 0.0, leaf(whole), leaf(whole)
    return feature, cut, float(gain[feature, cut]), leaf(left[feature, cut]), leaf(right[feature, cut])


@dataclass
class Growing:
    """A tree of which some levels stand."""
    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    leaf: np.ndarray = field(init=False)
    level: int = 0

    def __post_init__(self):
        inner = (1 << self.depth) - 1
        self.feature, self.cut = np.zeros(inner, np.int16), np.full(inner, NO_SPLIT, np.uint8)
        self.gain, self.leaf = np.zeros(inner), np.zeros(inner + 1)

    def split(self, found: dict[int, tuple]) -> None:
        """One more level from its nodes' best splits; a node without rows has none."""
        for node, (feature, cut, gain, left, right) in found.items():
            at = node + (1 << self.level) - 1
            self.feature[at], self.cut[at], self.gain[at] = feature, cut, gain
            if self.level == self.depth - 1:
                self.leaf[2 * node:2 * node + 2] = left, right
        self.level += 1

    def forest(self, base: float) -> Forest:
        return Forest(base, self.feature[None], self.cut[None], self.gain[None], self.leaf[None])


# --- tasks ------------------------------------------------------------------

#: Predictions of the blocks that this worker has seen: trees applied and their sum.
_SEEN: dict[tuple, tuple[int, np.ndarray]] = {}


class Block:
    """The rows of a partition for one target, with its predictions so far."""

    def __init__(self, run: str, part: int, arrays: tuple, k: int, target: Target, forest: Forest, settings: Settings):
        for old in [x for x in _SEEN if x[0] != run]:
            del _SEEN[old]
        bins, labels, self.key = arrays
        self.bins = np.asfortranarray(bins)   # by column
        self.columns = Columns.of(self.bins, settings.bins)
        self.target, self.label, self.settings = target, labels[:, k], settings
        self.place = (run, part, k)
        self.done, self.margin = _SEEN.get(self.place) or (0, np.full(len(self.bins), forest.base))
        self.apply(forest.part(self.done))

    def apply(self, trees: Forest) -> None:
        trees.add_to(self.margin, self.bins)
        self.done += len(trees)
        _SEEN[self.place] = (self.done, self.margin)

    def begin(self) -> None:
        """Derivatives of the rows that the next round sees."""
        self.used = np.flatnonzero(sampled(self.key, self.done, self.settings))
        self.g, self.h = derivatives(self.target, self.margin[self.used], self.label[self.used])
        self.node, self.level, self.total = np.zeros(len(self.bins), np.uint8), 0, None

    @property
    def rows(self) -> np.ndarray:
        """Bins of the rows that the round sees."""
        return self.bins[self.used]

    def _descend(self, tree: Growing, level: int) -> None:
        """All rows go down, also those that the round does not see: the grown tree needs
        their leaves as well."""
        if level > self.level:
            self.node = descend(self.bins, self.node, tree.feature, tree.cut, self.level, level)
        self.level = level

    def sums(self, tree: Growing) -> np.ndarray:
        """The block's sums for the nodes of the tree's next level.  Where those of the
        level above are at hand only the smaller child of each node is counted; the
        other is the rest of its parent, exactly, as the sums are whole numbers."""
        before = self.total if self.total is not None and self.level == tree.level - 1 else None
        self._descend(tree, tree.level)
        nodes, width, node = 1 << tree.level, self.settings.bins, self.node[self.used]
        if before is None:
            self.total = sums(replace(self.columns, at=self.used), node, self.g, self.h, nodes, width)
            return self.total
        rows = np.bincount(node, None, nodes).reshape(-1, 2)
        less = np.arange(0, nodes, 2) + rows.argmin(1)
        mine = np.zeros(nodes, bool)
        mine[less] = True
        at = np.flatnonzero(mine[node])
        counted = sums(replace(self.columns, at=self.used[at]), node[at] >> 1, self.g[at], self.h[at], nodes >> 1, width)
        self.total = np.empty((nodes, *counted.shape[1:]), np.int64)
        self.total[less], self.total[less ^ 1] = counted, before - counted
        return self.total

    def grown(self, tree: Growing) -> None:
        """Apply the tree that was grown: the rows go on from the level where they are."""
        self._descend(tree, tree.depth)
        self.margin += np.take(tree.leaf, self.node)
        self.done += 1
        _SEEN[self.place] = (self.done, self.margin)


class Placed:
    """The rows of a partition in the scratch folder of the executor that has them, where
    Spark's own spills go, as the task of target ``k`` sees them.  Any of its workers maps them; nothing
    is unpickled.

    Files never change: what a task works out for a round or level is a new file under their
    numbers, named when it is whole.  So tasks that run twice or end halfway do no harm, and what is not there is
    worked out again from the trees."""

    def __init__(self, folder: str, k: int, target: Target, settings: Settings, base: float, trees: Callable[[int], Forest], done: int):
        self.folder, self.own, self.target, self.settings, self.base = folder, f"{folder}/{k}", target, settings, base
        self.trees, self.done = trees, done   # trees(begin): those from ``begin`` to ``done``
        self.columns = Columns(*[_mapped(f"{folder}/{name}.npy") for name in ("one", "two")])
        self.label, self.key = _mapped(f"{folder}/labels.npy")[k], _mapped(f"{folder}/key.npy")
        self.bins = self.columns.one.T

    @staticmethod
    def folder_of(run: str, part: int) -> str:
        places = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
        return f"{places[part % len(places)]}/python/gridcast-{run}/{part}"

    @staticmethod
    def place(folder: str, arrays: tuple, settings: Settings) -> None:
        """Write the rows by column; the folder is there whole or not at all."""
        if os.path.isdir(folder):
            return
        bins, labels, key = arrays
        os.makedirs(os.path.dirname(folder), exist_ok=True)
        own, columns = tempfile.mkdtemp(dir=os.path.dirname(folder)), Columns.of(bins, settings.bins)
        for name, a in (("one", columns.one), ("two", columns.two), ("labels", np.ascontiguousarray(labels.T)), ("key", key)):
            np.save(f"{own}/{name}.npy", a)
        for k in range(labels.shape[1]):
            os.mkdir(f"{own}/{k}")
        try:
            os.rename(own, folder)
        except OSError:   # another task was first
            shutil.rmtree(own, ignore_errors=True)

    def _get(self, name: str) -> np.ndarray | None:
        try:
            return _mapped(f"{self.own}/{name}-{self.done}.npy")
        except FileNotFoundError:
            return None

    def _keep(self, name: str, a: np.ndarray) -> np.ndarray:
        own = f"{self.own}/{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            np.save(f, a)
        os.replace(own, f"{self.own}/{name}-{self.done}.npy")
        return a

    def margin(self) -> np.ndarray:
        """Predictions with all trees so far: with the one of the last round from where its
        last level left the rows."""
        if (found := self._get("margin")) is not None:
            return found
        last, n = self.settings.depth - 1, self.done
        self.done = n - 1
        before, node = self._get("margin"), self._get(f"node{last}")
        self.done = n
        out = np.full(len(self.key), self.base) if before is None else np.array(before)
        trees = self.trees(0 if before is None else n - 1)
        if before is not None and node is not None:
            out += np.take(trees.leaf[0], descend(self.bins, node, trees.feature[0], trees.cut[0], last, last + 1))
        else:
            trees.add_to(out, self.bins)
        self._keep("margin", out)
        for old in os.listdir(self.own):   # of earlier rounds
            if old.endswith(".npy") and not old.endswith(f"-{n}.npy"):
                with contextlib.suppress(FileNotFoundError):
                    os.unlink(f"{self.own}/{old}")
        return out

    def begun(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows that the round sees and their derivatives."""
        found = [self._get(name) for name in ("used", "g", "h")]
        if any(a is None for a in found):
            used = np.flatnonzero(sampled(self.key, self.done, self.settings))
            found = [used, *derivatives(self.target, np.take(self.margin(), used), np.take(self.label, used))]
            for name, a in zip(("used", "g", "h"), found, strict=True):
                self._keep(name, a)
        return tuple(found)

    def node(self, tree: Growing) -> np.ndarray:
        """The nodes of all rows at the tree's next level."""
        level = tree.level
        if (found := self._get(f"node{level}")) is not None:
            return found
        before = self._get(f"node{level - 1}")
        begin, before = (0, np.zeros(len(self.key), np.uint8)) if before is None else (level - 1, before)
        return self._keep(f"node{level}", descend(self.bins, before, tree.feature, tree.cut, begin, level))

    def sums(self, tree: Growing, nodes: Sequence[int]) -> np.ndarray:
        """The block's sums for some nodes of the tree's next level.  Rows are counted node
        after node, so that a count's places are near one another."""
        used, g, h = self.begun()
        if not tree.level:
            return sums(replace(self.columns, at=used), np.zeros(len(used), np.uint8), g, h, 1, self.settings.bins)
        number = np.full(1 << tree.level, -1, np.int16)
        number[list(nodes)] = np.arange(len(nodes))
        mine = np.take(number, np.take(self.node(tree), used))
        at = np.flatnonzero(mine >= 0)
        at = at[np.argsort(mine[at], kind="stable")]
        return sums(replace(self.columns, at=np.take(used, at)), mine[at], np.take(g, at), np.take(h, at), len(nodes), self.settings.bins)


def _mapped(path: str) -> np.ndarray:
    return np.asarray(np.load(path, mmap_mode="r"))


def _block(width: int, n_labels: int):
    """One block of arrays from the written rows of a partition."""
    def run(rows: Iterator) -> Iterator[tuple]:
        parts = [(np.frombuffer(bins, np.uint8).reshape(-1, width), np.frombuffer(labels, np.float64).reshape(-1, n_labels),
                  np.frombuffer(key, np.uint64)) for bins, labels, key in rows]
        parts = parts or [(np.empty((0, width), np.uint8), np.empty((0, n_labels)), np.empty(0, np.uint64))]
        bins, labels, key = (np.concatenate(p) for p in zip(*parts, strict=True))
        yield np.asfortranarray(bins), labels, key
    return run


def children(before: np.ndarray, nodes: Sequence[int], counted: Sequence[np.ndarray]) -> np.ndarray:
    """Sums of all nodes of a level from those of the level above and of one child of each
    node that was split.  A node that was not sends its rows left."""
    total = np.zeros((2 * len(before), *before.shape[1:]), np.int64)
    total[::2] = before
    for node, found in zip(nodes, counted, strict=True):
        total[node], total[node ^ 1] = found, before[node >> 1] - found
    return total


def smaller(total: np.ndarray, found: dict[int, tuple]) -> list[int]:
    """Of each node that was split the child with less of the second derivatives."""
    out = []
    for node, (feature, cut, *_) in sorted(found.items()):
        if cut != NO_SPLIT:
            left, right = (int(x.sum()) for x in np.split(total[node, feature, :, 1], [cut + 1]))
            out.append(2 * node + (right < left))
    return out


class Trainer:
    """Grows the forests of all targets over the blocks of rows."""

    def __init__(self, blocks, targets: Sequence[Target], bases: Sequence[float], settings: Settings):
        self.sc, self.run = blocks.context, uuid.uuid4().hex
        self.targets, self.settings = list(targets), settings
        self.forests = [Forest.empty(b, settings.depth) for b in bases]
        self.parts = blocks.getNumPartitions()
        self.rows, self.placed, self.placing, self.over = blocks, None, threading.Lock(), threading.Event()
        # one block: a partition for each target, so that targets are worked on side by side
        self.blocks = self.sc.union([blocks.mapPartitionsWithIndex(
            lambda i, it, k=k: ((k, i, arrays) for arrays in it), preservesPartitioning=True) for k in range(len(self.targets))])
        self.held: dict[int, tuple] = {}

    def _trees(self, k: int) -> Callable[[int], Forest]:
        """A target's trees from some round on, for tasks.  Trees of earlier jobs are broadcast
        now and then, the few since are sent along."""
        if k not in self.held or len(self.forests[k]) - self.held[k][0] >= TREES_ALONG:
            if k in self.held:
                self.held[k][1].unpersist()
            self.held[k] = (len(self.forests[k]), self.sc.broadcast(self.forests[k]))
        n, before = self.held[k]
        since = self.forests[k].part(n)
        return lambda begin: since.part(begin - n) if begin >= n else before.value.part(begin).plus(since)

    def _job(self, work):
        """``work(block)`` for the one block and every target."""
        run, targets, settings, trees = self.run, self.targets, self.settings, [self._trees(k) for k in range(len(self.targets))]

        def task(it: Iterator):
            for k, part, arrays in it:
                yield from work(k, Block(run, part, arrays, k, targets[k], trees[k](0), settings))
        return self.blocks.mapPartitions(task)

    def _rounds_in_task(self, rounds: int) -> None:
        settings = self.settings

        def work(k: int, block: Block):
            trees = Forest.empty(0.0, settings.depth)
            for _ in range(rounds):
                block.begin()
                tree = Growing(settings.depth)
                for level in range(settings.depth):
                    total = block.sums(tree)
                    tree.split({n: best_split(t, settings) for n, t in enumerate(total) if t[0, :, 1].any()})
                trees = trees.plus(tree.forest(0.0))
                block.grown(tree)
            yield k, trees
        for k, trees in self._job(work).collect():
            self.forests[k] = self.forests[k].plus(trees)

    def _place(self, gone=None) -> None:
        """Put every block where its task runs.  The cached partition of a block's number tells Spark
        to send its tasks there."""
        with self.placing:
            if self.placed is not gone:   # another target was first
                return
            run, settings = self.run, self.settings

            def task(i: int, it: Iterator):
                for arrays in it:
                    Placed.place(Placed.folder_of(run, i), arrays, settings)
                yield i
            if gone:
                gone.unpersist()
            self.placed = self.rows.mapPartitionsWithIndex(task).persist()
            self.placed.count()

    def _counted(self, k: int, tree: Growing, nodes: list[int]) -> list[np.ndarray]:
        """Sums over all blocks of some nodes.  A job that meets a block which is not where its task
        runs (an executor is gone) places the blocks anew."""
        run, target, settings, base, trees, done = self.run, self.targets[k], self.settings, self.forests[k].base, self._trees(k), len(self.forests[k])

        def task(i: int, it: Iterator):
            folder = Placed.folder_of(run, i)
            if os.path.isdir(folder):
                yield from enumerate(Placed(folder, k, target, settings, base, trees, done).sums(tree, nodes))
            else:
                yield -1, 1
            for _ in it:   # last, as the work needs nothing of it and need not wait
                pass
        for _ in range(LOST_JOBS):
            placed, out = self.placed, {}
            found = placed.mapPartitionsWithIndex(task)
            if self.parts > BLOCKS_GATHERED:
                found = found.reduceByKey(lambda a, b: a + b, min(self.parts, len(nodes)))
            for n, total in found.collect():
                out[n] = out[n] + total if n in out else total
            if -1 not in out:
                return [out[n] for n in range(len(nodes))]
            self._place(placed)
        raise RuntimeError("blocks of rows are lost again and again")

    def _round_by_level(self, k: int) -> None:
        settings, tree = self.settings, Growing(self.settings.depth)
        nodes, total = [0], None
        for level in range(settings.depth):
            counted = self._counted(k, tree, nodes) if nodes else []
            total = children(total, nodes, counted) if level else np.stack(counted)
            found = {n: best_split(t, settings) for n, t in enumerate(total) if t[0, :, 1].any()}
            nodes = smaller(total, found)
            tree.split(found)
        self.forests[k] = self.forests[k].plus(tree.forest(0.0))

    def _by_level(self, k: int) -> None:
        try:
            while len(self.forests[k]) < self.settings.rounds and not self.over.is_set():
                self._round_by_level(k)
        except BaseException:
            self.over.set()
            raise

    def fit(self) -> list[Forest]:
        if self.parts == 1:
            while (left := self.settings.rounds - len(self.forests[0])) > 0:
                self._rounds_in_task(min(left, ROUNDS_A_JOB))
            return self.forests
        self._place()
        # targets do not wait for one another: the tasks of one fill the cores while another's splits are looked for
        with ThreadPoolExecutor(len(self.targets)) as pool:
            try:
                list(pool.map(inheritable_thread_target(SparkSession.active())(self._by_level), range(len(self.targets))))
            finally:
                self.over.set()
        return self.forests

    def close(self) -> None:
        """Delete the blocks where they lie."""
        if self.placed:
            run = self.run

            def task(i: int, it: Iterator):
                shutil.rmtree(Placed.folder_of(run, i), ignore_errors=True)
                yield from it
            self.placed.mapPartitionsWithIndex(task).count()
            self.placed.unpersist()


# --- binning ----------------------------------------------------------------

def bin_edges(df: DataFrame, values: Sequence[F.Column], bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each column: quantiles, in one aggregate."""
    at = [float(x) for x in np.arange(1, bins) / bins]
    row = df.agg(F.array(*[F.percentile_approx(v, at, 10_000) for v in values]).alias("q")).first()
    return [np.unique(np.array(q or [], np.float64)) for q in row.q]


def to_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value, one byte a feature; above the last edge, and NaN, the last."""
    out = np.empty((len(edges), len(values)), np.uint8)
    for i, e in enumerate(edges):
        out[i] = np.searchsorted(e, values[:, i], side="left")
    return out.T


def binned(df: DataFrame, values: Sequence[F.Column], labels: Sequence[F.Column], edges: Sequence[np.ndarray], partitions: int) -> DataFrame:
    """Blocks of rows as a written table: ``bins``, ``labels`` and ``key`` as bytes.  Rows are
    binned where they are, by all tasks; a byte a feature moves to its block."""
    n, m = len(values), len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in at], 1) for at in (range(n), range(n, n + m)))
            blob = (to_bins(x, edges).tobytes(), y.astype(np.float64).tobytes(), b.column(b.num_columns - 1).to_numpy().astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([z], pa.binary()) for z in blob], names=["bins", "labels", "key"])
    plain = df.select(*[v.alias(f"f{i}") for i, v in enumerate(values)], *[y.alias(f"y{i}") for i, y in enumerate(labels)],
                      F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]).alias("key"))
    return materialize(plain.mapInArrow(run, "bins binary, labels binary, key binary").repartition(partitions)
                       .withColumn("block", F.spark_partition_id()), "binned")


def blocks_of(rows: int, cores: int, targets: int, rows_a_block: int) -> int:
    """One block if it holds all rows.  Else so many that the targets' tasks together are half
    as many again as there are cores (but a task a core is enough), or a multiple of that."""
    need, wide = -(-rows // rows_a_block), max(1, min(cores, -(-3 * cores // (2 * targets)), rows // LEAST_ROWS))
    return 1 if need <= 1 else wide * -(-need // wide)


def fit_forests(df: DataFrame, features: Sequence[str], targets: Sequence[Target], settings: Settings,
                rows_a_block: int = ROWS_A_BLOCK) -> tuple[list[np.ndarray], list[Forest]]:
    """Bin edges and the forest of each target.  Missing features count as 0; rows that
    miss a label are left out."""
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in features]
    labels = [F.col(f"`{t.label}`").cast("double") for t in targets]
    rows = materialize(df.where(" and ".join(f"`{t.label}` is not null" for t in targets)), "training_rows")
    n, *means = rows.agg(F.count("*"), *[F.avg(y) for y in labels]).first()
    if not n:
        raise ValueError("no training rows with all labels")
    edges = bin_edges(rows, values, settings.bins)
    bases = [float(np.log(m / (1 - m))) if t.loss == "log" and 0 < m < 1 else float(m) if t.loss != "log" else 0.0
             for t, m in zip(targets, means, strict=True)]
    parts = blocks_of(n, rows.sparkSession.sparkContext.defaultParallelism, len(targets), rows_a_block)
    table = binned(rows, values, labels, edges, parts)
    # a scan cuts files into splits of its own, so rows go by the block's number; one block is kept in memory
    dealt = table.rdd.map(lambda r: (r.block, (r.bins, r.labels, r.key)))
    dealt = dealt.coalesce(1) if parts == 1 else dealt.partitionBy(parts, int)
    blocks = dealt.values().mapPartitions(_block(len(features), len(targets)))
    trainer = Trainer(blocks.persist() if parts == 1 else blocks, targets, bases, settings)
    try:
        return edges, trainer.fit()
    finally:
        trainer.close()
        blocks.unpersist()
