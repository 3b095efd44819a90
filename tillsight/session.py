"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SETTINGS = {
    # Timestamps carry no zone; UTC keeps NTZ <-> LTZ casts free of DST jumps.
    "spark.sql.session.timeZone": "UTC",
    # AQE coalesces small shuffle partitions, splits skewed join partitions and
    # turns a shuffle join into a broadcast join once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites are not recorded for every column expression: plans build faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tillsight", master: str | None = None, **settings) -> SparkSession:
    """Create (or fetch) a session with the settings the plans rely on.

    ``spark.sql.shuffle.partitions`` is left to the deployment: a few times the
    core count, large enough that one partition fits in executor memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; below the warehouse in local mode without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_frames")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


_written: list[list[str]] = []


def cut_lineage(df: DataFrame, schema: StructType | None = None, kept: bool = False) -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back.

    Model fits read their input dozens of times. From a written table a lost task
    re-reads files instead of replaying joins, and later readers keep column
    pruning, filter pushdown and real sizes, which an RDD checkpoint would hide.
    Inside ``owned_frames`` the table is dropped at the end unless it is ``kept``. A ``schema`` gives columns
    another type that is stored alike, such as a user-defined one.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"frame-{uuid.uuid4().hex}")
    if _written and not kept:
        _written[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


@contextlib.contextmanager
def owned_frames(spark: SparkSession) -> Iterator[None]:
    """Drops the frames that a job wrote with ``cut_lineage`` when its block ends, also
    after an error. Results must be written or collected inside the block."""
    _written.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _written.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder for tables that a later step reads back."""
    return os.path.join(checkpoint_dir(spark), name)
