"""What a session needs before its executors can run this package's functions."""

from __future__ import annotations

import functools
import io
import os
import tempfile
import time
import zipfile
from collections.abc import Callable

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20  # of a batch, or one row; Spark itself counts rows, so long texts come by tens of MB, several times in the JVM and in Python
TRIM_SECONDS = 5  # between two calls that give memory back
_shipped: set[str] = set()
_trimmed = float("-inf")


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow functions get their rows in batches of some MB, unless the session says otherwise. Every row still comes, in the same order."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    path = os.path.join(tempfile.mkdtemp(prefix="guidemill-"), "guidemill.zip")
    with open(path, "wb") as f:
        f.write(out.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def give_back(spark: SparkSession) -> str | None:
    """Memory outside the heap that the driver's JVM has freed goes back to the system; what the JVM says to it, or None where it can't.

    Hundreds of threads (compilers, compressors, senders of blocks) allocate it in dozens of arenas, and the C library keeps what they free:
    over a long chain of jobs that adds up to hundreds of MB."""
    jvm = spark._jvm
    try:
        named = jvm.java.lang.Class.forName
        kinds = spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 4)
        for k, name in enumerate(["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"]):
            kinds[k] = named(name)
        args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by reflection, because the server's own class isn't open to Py4J
        return named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Exception:  # another JVM or system: nothing depends on it
        return None


def give_back_now_and_then(spark: SparkSession) -> None:
    """give_back(), TRIM_SECONDS after the last time at the earliest: it takes some ms and forces pages to be touched again."""
    global _trimmed
    if time.monotonic() - _trimmed >= TRIM_SECONDS:
        give_back(spark)
        _trimmed = time.monotonic()


def shipped(f: Callable) -> Callable:
    """f, whose first argument is the session, with the package sent and batches bounded before."""

    @functools.wraps(f)
    def run(spark: SparkSession, *args):
        ship(spark)
        bound_batches(spark)
        return f(spark, *args)

    return run
