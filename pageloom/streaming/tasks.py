"""Page tasks as streams: new files in, a log of events, the latest state of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Events of a task in the order of its life; an inner failure still ends. Fixed values.
EVENTS = ("starttime", "Insideendtime", "endtime", "Insideerrortime", "errortime")
LOG = T.StructType().add("file_name", "string").add("event", "string").add("ts", "timestamp").add("error", "string")


def stream_log(spark: SparkSession, folder: str, schema: T.StructType = LOG, files_per_trigger: int = 100) -> DataFrame:
    """The JSON log files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def stream_pages(spark: SparkSession, folder: str, pattern: str = "*.png", files_per_trigger: int = 100) -> DataFrame:
    """New page images as rows path, modificationTime, length, content: one task per file."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(kind).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).load(folder)


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that is there to Parquet, then stop; what was taken before is not taken again."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def latest_status(log: DataFrame, tie: str | None = None) -> DataFrame:
    """file_name, event, ts, n_events: the last event of each file (ties: largest ``tie``, then event)."""
    order = [F.col("ts"), *([F.col(tie)] if tie else []), F.col("event")]
    last = F.max(F.struct(*order)).alias("x")
    return log.groupBy("file_name").agg(last, F.count("*").alias("n_events")).select("file_name", "x.event", "x.ts", "n_events")


def failures(log: DataFrame) -> DataFrame:
    """file_name, n_errors, first_error of the files with an error event."""
    bad = log.where(F.col("event").contains("error"))
    return bad.groupBy("file_name").agg(F.count("*").alias("n_errors"), F.min("ts").alias("first_error"))


def durations(log: DataFrame, begin: str = "starttime", end: str = "endtime") -> DataFrame:
    """file_name, seconds from the first begin to the last end; null while it runs."""
    t = lambda e, f: f(F.when(F.col("event") == e, F.col("ts")))
    d = log.groupBy("file_name").agg(t(begin, F.min).alias("a"), t(end, F.max).alias("b"))
    return d.select("file_name", (F.col("b").cast("double") - F.col("a").cast("double")).alias("seconds"))


def time_totals(log: DataFrame, begin: str = "starttime", end: str = "endtime") -> DataFrame:
    """n_files, n_done, seconds: one row over all files of the log."""
    d = durations(log, begin, end)
    return d.agg(F.count("*").alias("n_files"), F.count("seconds").alias("n_done"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))


def progress(log: DataFrame, total: int, end: str = "endtime") -> DataFrame:
    """done, total, percent (one decimal) and seconds since the log's first event: how far a batch has come."""
    done = F.count_distinct(F.when(F.col("event") == end, F.col("file_name")))
    d = log.agg(done.alias("done"), (F.max("ts").cast("double") - F.min("ts").cast("double")).alias("seconds"))
    return d.select("done", F.lit(total).cast("long").alias("total"), F.round(100 * F.col("done") / F.lit(max(total, 1)), 1).alias("percent"), "seconds")


def load_multiplier(files: DataFrame, copies: int = 100) -> DataFrame:
    """Each row ``copies`` times, numbered from 0: a load generator (a fixed factor, by explode)."""
    return files.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
