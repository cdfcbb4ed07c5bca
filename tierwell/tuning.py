"""Session settings the plans profit from.  Only settings left at their default are changed."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SETTINGS = {
    # The JVM does not compile methods beyond 8000 bytes of bytecode.  Typing and judging a wide
    # row can generate a longer one; many small methods then beat one that is interpreted forever.
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    # Split a hot key's join partition even where that costs another shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": ("false", "true"),
    # Well packed files hold many rows a megabyte: a task that sorts what it reads should not spill it.
    "spark.sql.files.maxPartitionBytes": ("134217728b", "16m"),
    # A batch for a Python worker is held by the JVM outside its heap and by the worker, each way and for
    # every step of a task; rows of long texts fill the default limit.
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m"),
}


def tune(spark: SparkSession) -> SparkSession:
    for name, (default, better) in _SETTINGS.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, better)
    return spark
