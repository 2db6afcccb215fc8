"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import scratch_path

#: Characters between words in the contracts: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"

_OPEN: list[tuple[SparkSession, str]] = []
#: Names of those staged as bucketed tables, by folder.
_TABLES: dict[str, str] = {}


def stage_table(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a recomputation) and
    fixes the rows that several branches see.  The folder lives until
    :func:`release`, or else as long as the application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    _OPEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """Write ``df`` in the shared folder as a table bucketed by a column and read it
    back: grouping and cogrouping by that column do not move its rows again."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = scratch_path(spark, f"llm/{table}")
    (df.write.option("path", path).option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6")
     .bucketBy(buckets, by).format("parquet").saveAsTable(table))
    _OPEN.append((spark, path))
    _TABLES[path] = table
    return spark.table(table)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system (any store Spark can write)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def staged(spark: SparkSession) -> list[str]:
    """Folders of the staged tables that are there."""
    return [path for s, path in _OPEN if s is spark]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables; what was built on them must have been written."""
    for path in paths:
        if path in _TABLES:
            spark.sql(f"drop table if exists {_TABLES.pop(path)}")
        drop_path(spark, path)
        if (spark, path) in _OPEN:
            _OPEN.remove((spark, path))


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder in the shared folder for a table of one's own."""
    return scratch_path(spark, f"llm/{name}")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file: TOKENIZER_DIR, or the installed package."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def text_of(text: Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null and blank give none."""
    trimmed = F.btrim(text_of(text), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RE, -1))


def n_words_of(text: Column) -> Column:
    """How many words :func:`words_of` has, without building strings for them."""
    return F.regexp_count(text_of(text), F.lit(NOT_SPACE_RE)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` is used where a text is pure ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
