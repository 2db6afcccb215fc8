"""From raw documents to training sequences: five operators one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again before the next stage begins, which is when the
next stage frees what the one before had staged in the shared folder.  All but the
last return the columns of ``docs``.

A stage sees the columns that its operator reads and one struct, ``doc``, of all
others under names of its own (``packed``), so a column of any name, also
one that an operator uses inside, is carried as it is.

Defined cases: those of the operators; null ids and repeated rows are carried, a
column of any name is carried unless an operator reads it.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import decontam, kn_quality, mixing, simhash, training_order
from gridcast.llm.common import release, stage_path, staged, tokenizer_path, words_of


#: What the stage before staged, by session; its result is written when the next begins.
_BEFORE: dict[int, list[str]] = {}


def frees_the_stage_before(stage):
    """Deletes what the stage called before has staged, and nothing else."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _BEFORE.pop(id(spark), []))
        there = set(staged(spark))
        out = stage(spark, docs, sf_dir)
        _BEFORE[id(spark)] = [p for p in staged(spark) if p not in there]
        return out
    return run_stage


def packed(docs: DataFrame, *read: str) -> DataFrame:
    """The columns ``read`` and all others as one struct ``doc``."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in read]
    return docs.select(*read, F.struct(F.lit(0).alias("none"), *others).alias("doc"))


def unpacked(rows: DataFrame, like: DataFrame, *read: str, at: str = "") -> DataFrame:
    """The columns of ``like`` from packed rows, or from a struct ``at`` of such."""
    return rows.select(*[F.col(f"{at}{c}" if c in read else f"{at}doc.c{i}").alias(c) for i, c in enumerate(like.columns)])


@frees_the_stage_before
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    read = ("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = kn_quality.classify(packed(docs, *read), labels, carry=(*read, "doc"))
    return unpacked(found.filter("kept").select(F.col("doc").alias("row")), docs, *read, at="row.")


@frees_the_stage_before
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the least id (null last), and
    of those the one of least hash; of equal rows one."""
    read = ("doc_id", "text")
    rows = packed(docs, *read)
    rows = rows.select("*", F.xxhash64("text").alias("text_hash"), F.xxhash64(*rows.columns).alias("row_hash"))
    found = simhash.simhash_components(rows.drop("doc"), carry=("text_hash", "row_hash"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash", "row_hash")).alias("best")
    stay = found.groupBy("root").agg(best).select("best.text_hash", "best.row_hash").distinct()
    rows = rows.join(stay.hint("shuffle_hash"), ["text_hash", "row_hash"], "left_semi")
    return unpacked(rows.dropDuplicates(["text_hash", "row_hash"]), docs, *read)


@frees_the_stage_before
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    read = ("doc_id", "text")
    rows = packed(docs, *read)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(rows, items).filter("contaminated")
    gone = found.select(F.xxhash64("doc_id").alias("id_hash"), "text_hash").distinct()
    rows = rows.select("*", F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"))
    return unpacked(rows.join(gone.hint("shuffle_hash"), ["id_hash", "text_hash"], "left_anti"), docs, *read)


@frees_the_stage_before
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one that a source's target cuts
    has the words that are taken."""
    read = ("doc_id", "text", "source")
    found = mixing.mix(packed(docs, *read), carry=(*read, "doc"))
    drawn = found.select(F.col("doc").alias("row"), "size", F.explode("draws").alias("d"))
    cut = F.array_join(F.slice(words_of(F.col("row.text")), F.lit(1), F.col("d.words").cast("int")), " ")
    text = F.when(F.col("d.words") < F.col("size"), cut).otherwise(F.col("row.text"))
    return unpacked(drawn.withColumn("row", F.col("row").withField("text", text)), docs, *read, at="row.")


@frees_the_stage_before
def order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order."""
    return training_order.training_order(docs.select("doc_id", "text"), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token-ID output", order),
]

#: A learned classifier, fingerprints of a 64-bit hash and a keyed permutation have no
#: SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = uuid.uuid4().hex
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = stage_path(spark, f"pipeline-{name}-{k}")
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
