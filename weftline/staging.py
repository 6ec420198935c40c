"""Tables written between stages, in the folder that all executors share.

Lineage is cut by writing a Parquet table under ``spark.checkpoint.dir`` and reading it again; a lost executor
then costs no recomputation of earlier stages. Where the session names no such folder (tests), a folder of our
own is made once and set.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder of the cluster, or one of our own if a local session has none."""
    if not (root := spark.conf.get("spark.checkpoint.dir", None)):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted at the end."""
    path = f"{shared_root(spark)}/weftline/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def put(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df to the shared folder and return a reader of it; ``_staged`` on the result holds the path."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that put() wrote and that nothing reads any more."""
    if path := getattr(df, "_staged", None):
        _delete(df.sparkSession, path)
        _made.remove((df.sparkSession, path))


def mark() -> int:
    """A point in the order of staged tables, for drop_since."""
    return len(_made)


def drop_since(point: int, keep: tuple[DataFrame, ...] = ()) -> None:
    """Delete the tables staged since a mark, but for those that are still read."""
    kept = {df._staged for df in keep}
    gone = [(spark, path) for spark, path in _made[point:] if path not in kept]
    for spark, path in gone:
        _delete(spark, path)
        _made.remove((spark, path))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries; else they stay until the driver happens to collect its garbage.

    The cleaner works in its own thread, and what it frees first holds the rest: one collection is not enough. The
    driver's free native memory then goes back to the system: compiling the plans of many small queries on many threads
    leaves some hundreds of MB of it with the allocator, beside the heap.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
    _trim(spark)


def _trim(spark: SparkSession) -> None:
    """malloc_trim in the driver's JVM; nothing where the JVM has no such command (not Linux, before 17.0.9)."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        # The server's class is not exported: its method is called through the interface.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = gateway.new_array(jvm.java.lang.Object, 4)  # without parameters and their types
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended before the process; the folder's owner then clears it
            return
