"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_RUNS: dict[str, str] = {}


def build_session(app: str = "glyphatlas", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps; `conf` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; fall back to a local one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder, so that later steps survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_folder(spark: SparkSession) -> str:
    """A folder of this process beside the checkpoints, removed when the process ends."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    if root not in _RUNS:
        _RUNS[root] = f"{root}/run-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _RUNS[root])
    return _RUNS[root]


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back, so that later steps survive lost executors and the planner sees its true size.

    A checkpoint keeps the estimated size of the plan that it cuts: a loop that joins such tables with each other multiplies the estimate in every
    round. `replaces` is a settled table that nothing reads any longer: its files go.
    """
    spark = df.sparkSession
    place = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(place)
    out = spark.read.schema(df.schema).parquet(place)
    _PLACES[out] = place
    discard(replaces)
    return out


def discard(*frames: DataFrame | None) -> None:
    """Remove the files of settled tables that nothing reads any longer."""
    for df in frames:
        if df is not None and (place := _PLACES.pop(df, None)):
            _remove(df.sparkSession, place)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
