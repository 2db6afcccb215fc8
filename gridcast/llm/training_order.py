"""Operator 8: token ids in training order.

Every text becomes byte-level BPE ids with an end mark, cut into sequences of
``seq_len`` ids.  The ids are written to the shared
folder with a running number of sequences in each input split; the splits' sums
make the numbers global and without gaps, and a keyed Feistel permutation with
cycle-walking sends each number to its global slot: a shuffle of the whole corpus
that any task can evaluate for itself.  The order of the numbers is that of the
input's splits, so a rerun over the same files, split alike, gives the same slots.  Slots are cut into
shards of ``shard_len``; ``write_shards`` has one task write each shard as one raw
file of records of ``stride(seq_len)`` bytes in slot order, so slot ``s`` is at
``(s % shard_len) * stride`` of shard ``s // shard_len``; ``record`` is the records'
numpy type.  ``sequences_from`` seeks to any slot and reads on in order, and
``read_from`` does so with Spark, a shard at a time.

Texts are tokenised once, where they are read, and moved once, to their shards;
``write_order`` does both a range of shards at a time.  A
task holds the ids of a few megabytes of text, or of one longer text, at a time.

Defined cases: a null or empty text is one sequence with only the end mark; equal
rows each have slots of their own; null ids are kept;
an empty table gives an empty result and no shard; other columns are ignored.  A record
keeps an integer id as it is and of any other id its ``xxhash64``.
"""

from __future__ import annotations

import base64
import math
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gridcast.llm.common import drop_path, release, stage_path, stage_table, staged

SEQ_LEN = 1024
SHARD_LEN = 16_384
ROUNDS = 6
#: Ranges of shards that ``write_order`` works on one after the other, and Spark's setting that
#: deletes the shuffle of a write with its end.
TURNS, CLEANUP = 4, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What ends a record: two bytes, so that ids stay at even places of a file.
RECORD_END = "\n\n"
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def record(seq_len: int = SEQ_LEN) -> np.dtype:
    """A record of a shard: padded ids, how many are of the text, whether the id is null,
    the sequence's number in its text, and the id."""
    return np.dtype([("ids", "<u2", (seq_len,)), ("n_tokens", ">u2"), ("no_id", ">u2"), ("seq_no", ">u4"), ("id", ">i8"), ("end", "S2")])


def stride(seq_len: int = SEQ_LEN) -> int:
    return record(seq_len).itemsize


# --- permutation ------------------------------------------------------------

def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Keyed mixing of 64-bit words (multiply and xor-shift)."""
    x = x ^ np.uint64(key)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Slot of each number below ``n``: a bijection of 0 .. n - 1."""
    half = max(1, math.ceil((n - 1).bit_length() / 2)) if n > 1 else 1
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [(seed * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64) for r in range(1, ROUNDS + 1)]

    def once(x):
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(index, np.uint64))
        while len(far := np.flatnonzero(out >= np.uint64(n))):  # the domain is less than 4 n
            out[far] = once(out[far])
    return out.astype(np.int64)


# --- tokenising -------------------------------------------------------------

@lru_cache(maxsize=2)
def encoding(path: str):
    """Byte-level BPE of a rank file (one base64 token and its rank a line)."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids, each text with its end mark, and where each text begins."""
    bpe = encoding(path)
    parts = [[*bpe.encode_ordinary(t or ""), bpe.n_vocab] for t in texts.to_pylist()]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.r_[0, np.cumsum(sizes)]
    return np.fromiter(chain.from_iterable(parts), "<u2", begins[-1]), begins


def slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most)))
        yield at, stop
        at = stop


# --- operator ---------------------------------------------------------------

def _tokens(path: str, seq_len: int):
    """Ids of each text with the number of its first sequence in the partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for b in batches:
            for i, j in slices(b.column(2)):
                ids, begins = encode(path, b.column(2).slice(i, j - i))
                n_seq = -(-np.diff(begins) // seq_len)
                inside = done + np.cumsum(n_seq) - n_seq
                done += int(n_seq.sum())
                tokens = pa.array([ids[x:y].tobytes() for x, y in zip(begins[:-1], begins[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(inside), pa.array(n_seq), tokens],
                                                 names=["part", "id", "inside", "n_seq", "tokens"])
    return run


def _sequences(starts, seq_len: int, shard_len: int, n: int, seed: int, end: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b.column(3)):
                yield from rows_of(b.slice(i, j - i))

    def rows_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = [np.frombuffer(t.as_buffer(), "<u2") for t in b.column(3)]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        n_seq = -(-sizes // seq_len)
        doc = np.repeat(np.arange(len(raw)), n_seq)
        begun = np.cumsum(n_seq) - n_seq
        seq_no = np.arange(len(doc)) - begun[doc]
        used = np.minimum(seq_len, sizes[doc] - seq_no * seq_len)
        grid = np.full(len(doc) * seq_len, end, "<u2")
        for t, at in zip(raw, (begun * seq_len).tolist(), strict=True):
            grid[at:at + len(t)] = t
        first = starts.value[b.column(0).to_numpy()] + b.column(2).to_numpy()
        slot = permute(first[doc] + seq_no, n, seed)
        width = 2 * seq_len
        for at in range(0, len(doc), 1024):
            r = slice(at, at + 1024)
            k = len(doc[r])
            tokens = pa.Array.from_buffers(pa.binary(width), k, [None, pa.py_buffer(grid[at * seq_len:(at + k) * seq_len])]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array(slot[r]), pa.array((slot[r] // shard_len).astype(np.int32)), pa.array(slot[r] % shard_len * stride(seq_len)),
                b.column(1).take(pa.array(doc[r])), pa.array(seq_no[r].astype(np.int32)), pa.array(used[r].astype(np.int32)), tokens], schema=schema)
    return run


def training_order(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   seq_len: int = SEQ_LEN, shard_len: int = SHARD_LEN, seed: int = 8) -> DataFrame:
    """One row per sequence, range-partitioned into shards and in slot order inside:
    ``slot``, ``shard``, ``offset`` (bytes in the shard), id, ``seq_no``,
    ``n_tokens`` (without padding) and ``tokens`` (little-endian 16-bit ids)."""
    out, n = _placed(docs, tokenizer_path, id_col, text_col, seq_len, shard_len, seed)
    return out.repartitionById(max(1, -(-n // shard_len)), F.col("shard")).sortWithinPartitions("slot")


def _placed(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, seq_len: int, shard_len: int, seed: int) -> tuple[DataFrame, int]:
    """The sequences with their slots, where their texts were read, and how many there are."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(_tokens(tokenizer_path, seq_len), f"part int, id {id_type}, inside long, n_seq long, tokens binary")
    rows = stage_table(rows, "tokens", compression="zstd")
    # a number for each input split, which the driver has listed to run the job
    sizes = dict(map(tuple, rows.groupBy("part").agg(F.sum("n_seq")).collect()))
    sizes = np.array([sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)], np.int64)
    n = int(sizes.sum())
    starts = spark.sparkContext.broadcast(np.cumsum(sizes) - sizes)
    schema = f"slot long, shard int, offset long, id {id_type}, seq_no int, n_tokens int, tokens binary"
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    cut = _sequences(starts, seq_len, shard_len, max(n, 1), seed, encoding(tokenizer_path).n_vocab, arrow)
    out = rows.select("part", "id", "inside", "tokens").mapInArrow(cut, schema)
    return out.withColumnRenamed("id", id_col), n


def write_order(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                seq_len: int = SEQ_LEN, shard_len: int = SHARD_LEN, seed: int = 8, turns: int = TURNS) -> None:
    """``write_shards`` of the ``training_order``, a range of shards at a time, so that the
    staged rows, their shuffle and the padded records are not all on disk at once: the
    sequences are staged compressed by turn, then the tokens are deleted; each turn moves
    its sequences to their shards, writes these and deletes what it read."""
    spark, there = docs.sparkSession, set(staged(docs.sparkSession))
    sequences, n = _placed(docs, tokenizer_path, id_col, text_col, seq_len, shard_len, seed)
    shards = -(-n // shard_len)
    turns = min(turns, shards)
    by_turn = stage_path(spark, f"turns-{uuid.uuid4().hex}")
    first = [shards * t // turns for t in range(turns)] + [shards]   # of each turn
    turn = sum((F.col("shard") >= x).cast("int") for x in first[1:-1]) + F.lit(0)
    if turns:
        sequences.withColumn("turn", turn).write.option("compression", "zstd").partitionBy("turn").parquet(by_turn)
    release(spark, [p for p in staged(spark) if p not in there])
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")   # a turn's shuffle goes with its write
    try:
        for t in range(turns):
            mine = range(first[t], first[t + 1])
            rows = spark.read.schema(sequences.schema).parquet(f"{by_turn}/turn={t}")
            rows = rows.repartitionById(len(mine), F.col("shard") - mine[0])
            write_shards(rows, path, id_col, seq_len, shard_len, mine)
            drop_path(spark, f"{by_turn}/turn={t}")
    finally:
        spark.conf.set(CLEANUP, before)
        drop_path(spark, by_turn)


def write_shards(sequences: DataFrame, path: str, id_col: str = "doc_id", seq_len: int = SEQ_LEN, shard_len: int = SHARD_LEN,
                 only: range | None = None) -> None:
    """One raw file for each shard in ``path/shard=N``, written by one task under a
    temporary name and renamed when the job commits, on any store Spark can write.
    Shards that are there already stay, so a run that broke off is resumed by writing
    again.  It is refused if one of them holds other rows than ``sequences`` have for it:
    numbers follow the input's splits, and shards of two numberings repeat sequences and
    lose others.  ``only``: the shards whose sequences these are (None: all)."""
    if seq_len > 0xFFFF:
        raise ValueError("a record counts its ids in 16 bits")
    spark = sequences.sparkSession
    whole = sequences.schema[id_col].dataType.simpleString() in _WHOLE
    key = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
    rows = sequences.select("slot", "shard", key.alias("id"), "seq_no", "n_tokens", "tokens")
    done = [s for s in written_shards(spark, path) if only is None or s in only]
    if done:
        there = read_from(spark, path, 0, shard_len, seq_len, "id").filter(F.col("shard").isin(done)).select(rows.columns)
        mine, there = (_fingerprints(x) for x in (rows.filter(F.col("shard").isin(done)), there))
        other = there.join(mine, there.columns, "left_anti").select("shard").first()
        if other:
            raise ValueError(f"shard {other.shard} under {path} is of another numbering of the sequences")
        rows = rows.filter(~F.col("shard").isin(done))

    def field(value, n_bytes: int):
        return F.unhex(F.lpad(F.hex(value.cast("long")), 2 * n_bytes, "0"))

    parts = [F.col("tokens"), field(F.col("n_tokens"), 2), field(F.col("id").isNull().cast("int"), 2),
             field(F.col("seq_no"), 4), field(F.coalesce("id", F.lit(0)), 8)]
    # the text writer puts the bytes of a string out as they are
    lines = rows.sortWithinPartitions("shard", "slot").select("shard", F.concat(*parts).cast("string").alias("record"))
    lines.write.mode("append").option("lineSep", RECORD_END).option("compression", "none").partitionBy("shard").text(path)


def _fingerprints(rows: DataFrame) -> DataFrame:
    """(shard, n, mark): rows of each shard and what they hold, whatever their order."""
    return rows.groupBy("shard").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("slot", "id", "seq_no", "n_tokens", "tokens")).alias("mark"))


def written_shards(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the shards under ``path``; the write commits all its shards at once."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith("shard="))


def _records(slot: int, seq_len: int, shard_len: int, schema: pa.Schema):
    """Rows of whole shard files, from ``slot`` on; a task holds a few files at a time."""
    kind = record(seq_len)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = np.frombuffer(content.as_buffer(), kind)
                for at in range(max(0, slot - shard * shard_len), len(data), 1024):
                    r = data[at:at + 1024]
                    place = np.arange(at, at + len(r))
                    tokens = pa.Array.from_buffers(pa.binary(2 * seq_len), len(r), [None, pa.py_buffer(np.ascontiguousarray(r["ids"]))])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard * shard_len + place), pa.array(np.full(len(r), shard, np.int32)), pa.array(place * kind.itemsize),
                        pa.array(r["id"].astype(np.int64), mask=r["no_id"] == 1), pa.array(r["seq_no"].astype(np.int32)),
                        pa.array(r["n_tokens"].astype(np.int32)), tokens.cast(pa.binary())], schema=schema)
    return run


def read_from(spark: SparkSession, path: str, slot: int, shard_len: int = SHARD_LEN, seq_len: int = SEQ_LEN, id_col: str = "doc_id") -> DataFrame:
    """The columns of ``training_order`` from ``slot`` on, out of the shard files and in
    slot order within each: shards before it are not opened and records before it not
    looked at.  The id is a long (see above)."""
    schema = "slot long, shard int, offset long, id long, seq_no int, n_tokens int, tokens binary"
    empty = spark.createDataFrame([], schema)
    if not written_shards(spark, path):
        return empty.withColumnRenamed("id", id_col)
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= slot // shard_len)
    rows = files.select("shard", "content").mapInArrow(_records(slot, seq_len, shard_len, to_arrow_schema(empty.schema)), schema)
    return rows.withColumnRenamed("id", id_col)


def sequences_from(path: str, slot: int, shard_len: int = SHARD_LEN, seq_len: int = SEQ_LEN) -> Iterator[np.ndarray]:
    """Records from ``slot`` on for a trainer, without Spark: seeks in the slot's file and
    reads on, one record at a time, from any store that pyarrow opens."""
    fs, root = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
    kind, shard = record(seq_len), slot // shard_len
    offset = slot % shard_len * kind.itemsize
    while (folder := fs.get_file_info(f"{root}/shard={shard}")).type == pa.fs.FileType.Directory:
        files = [f for f in fs.get_file_info(pa.fs.FileSelector(folder.path)) if not f.base_name.startswith(("_", "."))]
        if len(files) != 1:
            raise ValueError(f"shard {shard} under {path} has {len(files)} files")
        with fs.open_input_file(files[0].path) as f:
            f.seek(offset)
            while len(raw := f.read(kind.itemsize)) == kind.itemsize:
                yield np.frombuffer(raw, kind)[0]
        shard, offset = shard + 1, 0
