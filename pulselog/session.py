"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# HotSpot never compiles a method above 8000 bytes of bytecode.  Record
# renderings are wide; fused into one method they would run interpreted, so
# such subtrees are better generated operator by operator.
# Records are long JSON texts with the same names in each: zstd takes half of
# the bytes that snappy takes.
_RUNTIME = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    "spark.sql.parquet.compression.codec": ("snappy", "zstd"),
}


# Level of zstd in Parquet files, and what it is where a query doesn't ask for another.
_LEVEL, _USUAL = "parquet.compression.codec.zstd.level", 3
_OWN_LEVEL = "spark.pulselog.zstdLevel"


def tune(spark: SparkSession, zstd_level: int = _USUAL) -> SparkSession:
    """Sets the runtime options that are still at their defaults.

    ``zstd_level`` holds for what is written until the next call, unless the session has its own.
    """
    for key, (default, value) in _RUNTIME.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    level = spark.conf.get(_LEVEL, None)
    if level == spark.conf.get(_OWN_LEVEL, None) and (level or zstd_level != _USUAL):
        for key in (_LEVEL, _OWN_LEVEL):
            spark.conf.set(key, str(zstd_level))
    return spark


def release_shuffles(spark: SparkSession, wait: bool = False) -> None:
    """Lets Spark delete the shuffle files of plans that nothing holds any more.

    It does so when the driver's collector has found such a plan, which may take until the disks
    of the executors are full. Call it where a stored table has taken the place of a large plan.
    Python tells the JVM up to a second late what it holds no more: with ``wait`` that is waited for,
    without it some files may stay until the next call.
    """
    gc.collect()
    if wait:
        time.sleep(1.5)
    spark.sparkContext._jvm.System.gc()


@contextmanager
def configured(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """Sets a runtime option for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``).

    A machine-local folder will do only where driver and executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pulselog-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
