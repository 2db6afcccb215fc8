"""File sources and sinks (S1-S6): bronze CSV in, season-partitioned Parquet out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import schemas


def _as_list(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _select_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pick columns by header name (CSV schemas are positional, so a fixed schema
    would misread a wide file); a missing column becomes a null text column."""
    present = set(df.columns)
    return df.select([F.col(c) if c in present else F.lit(None).cast("string").alias(c)
                      for c in columns])


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Data files under the paths (files, folders or globs), in name order."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        todo = list(fs.globStatus(p) or [])
        if not todo:
            raise FileNotFoundError(path)
        while todo:
            s = todo.pop()
            name = s.getPath().getName()
            if s.isDirectory():
                todo += list(fs.listStatus(s.getPath()))
            elif not name.startswith((".", "_")) and s.getLen() > 0:
                out.append(s.getPath().toString())
    return sorted(set(out))


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Give a written folder its name; fails if the store refuses."""
    p, fs = _file_system(spark, old)
    target = _file_system(spark, new)[0]
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot rename {old} to {new}")


#: Files whose first lines are read at a time.
HEADER_READS = 16


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file that is not blank (compressed files by their name)."""
    jvm = spark.sparkContext._jvm
    p, fs = _file_system(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    raw = fs.open(p)
    try:
        text = jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, "UTF-8")
        reader = jvm.java.io.BufferedReader(text)
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line or ""
    finally:
        raw.close()


def header_catalogue(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Files by their first line.  One line a file is read, many files at a time and
    without a Spark job, so the jobs that follow are as many as there are headers."""
    files, out = list_files(spark, paths), {}
    with ThreadPoolExecutor(HEADER_READS) as pool:
        for path, line in zip(files, pool.map(lambda f: first_line(spark, f), files), strict=True):
            out.setdefault(line, []).append(path)
    return out


def read_headed_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files as text columns, each by its own header, put together by name.

    Files are scanned together where their headers are equal; the CSV reader names
    the columns of each header from one of its files, and the scans are unioned by name.
    """
    out = None
    for files in header_catalogue(spark, paths).values():
        header = spark.read.option("header", "true").csv(files[0]).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(files)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType()) if out is None else out


def read_plays_csv(spark: SparkSession, path, seasons: Iterable[int] | None = None,
                   all_columns: bool = False) -> DataFrame:
    """Bronze play-by-play CSV, headered files, all text.

    ``path`` is a folder holding ``play_by_play_{season}.csv`` files, a file,
    or a list of files.  Every file is read by its own header and columns are
    matched by name; files with equal headers share one scan.  Without schema
    inference every column is text, so there is no extra pass, and the CSV reader
    parses only the selected columns.  ``all_columns`` keeps every column that some
    header has, null where a file lacks it.
    """
    paths = _as_list(path)
    if seasons is not None:
        root = paths[0].rstrip("/")
        paths = [f"{root}/play_by_play_{s}.csv" for s in seasons]
    df = read_headed_csv(spark, paths)
    return df if all_columns else _select_text(df, schemas.BRONZE_PLAY_COLUMNS)


def read_odds_csv(spark: SparkSession, path) -> DataFrame:
    """Bronze odds CSV (S2).  Instead of an inference pass the used columns are
    matched by header name and given explicit types."""
    df = read_headed_csv(spark, _as_list(path))
    df = _select_text(df, schemas.BRONZE_ODDS.fieldNames())
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name)
                      for f in schemas.BRONZE_ODDS.fields])


def read_layer(spark: SparkSession, path: str, seasons: Sequence[int] | None = None) -> DataFrame:
    """Season-partitioned Parquet layer; ``season`` comes from the folder names and a
    ``seasons`` list prunes partitions at planning time (S3)."""
    df = spark.read.parquet(path)
    if seasons is not None:
        df = df.where(F.col("season").isin(list(seasons)))
    return df


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer, read so that counts without a filter, of the whole or by its
    partition columns, are answered from file footers and no row group is read.

    That takes Spark's newer Parquet reader, which is set for this table alone, in a
    session of its own on the same cluster."""
    own = spark.newSession()
    older = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in older if x.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Whole gold table for training and serving (S4); never collected."""
    return spark.read.parquet(path)


def _partitioned_writer(df: DataFrame, partition_col: str, within: Sequence[str], observation=None):
    """Range-partition on (season, within...) before a partitioned write: each task
    writes one contiguous slice, so a season gets a few large files and a big
    season is still spread over many tasks (hash-partitioning on the season
    alone would put a whole season in one task).  An ``Observation`` is attached
    above the exchange, so it counts the written rows once (the range sampling
    job runs below it)."""
    keys = [partition_col] + [c for c in within if c in df.columns]
    out = df.repartitionByRange(*[F.col(k) for k in keys])
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    return out.write.mode("overwrite").partitionBy(partition_col)


def write_season(df: DataFrame, path: str, partition_col: str = "season",
                 within: Sequence[str] = ("game_id", "play_id"), observation=None) -> None:
    """Restate only the seasons present in ``df`` (dynamic partition overwrite)."""
    (_partitioned_writer(df, partition_col, within, observation)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def write_layer(df: DataFrame, path: str, partition_col: str = "season",
                within: Sequence[str] = ("game_id", "play_id"), observation=None) -> None:
    """Overwrite the whole table, partitioned by season."""
    (_partitioned_writer(df, partition_col, within, observation)
     .option("partitionOverwriteMode", "static").parquet(path))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
