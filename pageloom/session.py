"""Session builder, table access and shared work tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pageloom", **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes (UTC, AQE on)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    That is ``spark.checkpoint.dir`` of the session. Only where the session
    has none (tests, a laptop) is a folder below the warehouse used instead.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_made: list[tuple[SparkSession, str]] = []


def work_path(spark: SparkSession, tag: str) -> str:
    """A new folder for a work table; it goes when this process ends."""
    folder = f"{shared_dir(spark)}/pageloom-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_drop_all)
    _made.append((spark, folder))
    return f"{folder}/{tag}"


def _drop_all() -> None:
    for spark, folder in _made:
        with suppress(Exception):  # the session may be gone
            drop_path(spark, folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch, for plans that hand whole texts to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read, not a rerun.
    """
    spark = df.sparkSession
    path = work_path(spark, tag)
    with small_batches(spark):
        df.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Let the driver's JVM collect what finished steps left: plans, broadcasts, and by way of the context cleaner shuffle files.

    Its heap grows to its bound before it would do so by itself. What compilers, planning and many small tasks
    freed outside of the heap stays with malloc until it is asked for, as the JVM's command System.trim_native_heap does.
    """
    spark.sparkContext._jvm.System.gc()
    with suppress(Exception):  # not on every JVM
        _trim(spark)


def _trim(spark: SparkSession) -> str:
    """What the JVM's command says. The server's own class is closed to py4j, its interface is not."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    java = jvm.java.lang

    def array(kind, *values):  # noqa: ANN001, ANN002, ANN202
        out = gateway.new_array(kind, len(values))
        for k, v in enumerate(values):
            out[k] = v
        return out

    none, names = array(java.Object), array(java.String)
    command = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    kinds = [java.Class.forName(c) for c in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
    invoke = java.Class.forName("javax.management.MBeanServer").getMethod("invoke", array(java.Class, *kinds))
    return invoke.invoke(java.management.ManagementFactory.getPlatformMBeanServer(), array(java.Object, command, "systemTrimNativeHeap", none, names))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a work table whose readers have all finished."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
