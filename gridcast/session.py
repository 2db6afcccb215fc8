"""Session helpers: the settings every gridcast job relies on."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM leaves generated methods of more than 8,000 bytes uncompiled: their steps run one by one instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "gridcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time and AQE on.

    ``master`` is left to spark-submit unless given (tests pass ``local[*]``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        spark.conf.set(k, v)
    return spark


def _conf(spark: SparkSession, key: str):
    try:
        return spark.conf.get(key)
    except Exception:  # noqa: BLE001 - unset key
        return None


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. a Connect session)
        master = _conf(spark, "spark.master") or ""
    return re.match(r"local(\[|$)", master) is not None


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the session names, if any."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. a Connect session)
        return _conf(spark, "spark.checkpoint.dir")
    return sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) or _conf(spark, "spark.checkpoint.dir")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables: the one the cluster
    names in ``spark.checkpoint.dir``.  A session without it is an error; what runs
    in one process (tests, a smoke check) names a folder by ``use_own_folder``."""
    folder = configured_checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def use_own_folder(spark: SparkSession) -> None:
    """Name a temporary folder where the session has none; in one process only."""
    if not configured_checkpoint_dir(spark) and is_local(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridcast-"))


@contextlib.contextmanager
def held(spark: SparkSession, settings: dict[str, str]):
    """Settings of the session for a while."""
    before = {k: _conf(spark, k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_SCRATCH: set[tuple[int, str]] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in this application's own folder under the shared one, for written
    intermediate tables.  The folder is deleted when the driver's Python ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/gridcast-{spark.sparkContext.applicationId}"
    if (id(spark), root) not in _SCRATCH:
        _SCRATCH.add((id(spark), root))
        atexit.register(_delete, spark, root)
    return f"{root}/{name}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session is gone; its owner cleans the shared folder
        pass


def materialize(df, name: str, by: str | None = None):
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it
    back: cuts the lineage (recovery after a lost executor re-reads the files
    instead of recomputing upstream stages) and fixes values that must be seen
    identically by several branches.  One job, unlike ``checkpoint()`` which runs
    the plan once to count and again to save.

    With ``by`` the table is bucketed by that column, so what groups or joins by it later
    moves no row.  The rows of a key are gathered first (they have to be few): where
    ``df`` has them together already that is no shuffle, and a bucket is one file."""
    spark, own = df.sparkSession, uuid.uuid4().hex
    path = scratch_path(spark, f"{name}/{own}")
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    rows = df.withColumn("_rows_of_key", F.count(F.lit(1)).over(Window.partitionBy(by)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.option("path", path).bucketBy(buckets, by).format("parquet").saveAsTable(f"{name}_{own}")
    return spark.table(f"{name}_{own}").drop("_rows_of_key")
