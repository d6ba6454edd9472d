"""Queries of sources, sinks, task logs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.geometry import SIDES
from pageloom.operators import layout as L
from pageloom.operators.joins import bucketed_band_join
from pageloom.plans import fixtures as X
from pageloom.session import table, work_path
from pageloom.sources import readers as R
from pageloom.sources import writers as W
from pageloom.streaming import tasks as S


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the events' JSON, by a declared schema."""
    d = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,string>").alias("p"))
    return d.select("event_id", F.array_join(F.array_sort(F.transform(F.map_entries("p"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";").alias("props"))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as recorded OCR responses: a line, then its words in quarters of the crop."""
    d = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("w"))
    box = lambda i: F.struct(F.struct((i % 4 / 4.0).alias("Left"), (i / 1024.0).alias("Top"), F.lit(0.125).alias("Width"), F.lit(0.0625).alias("Height")).alias("BoundingBox"))
    block = lambda kind, text, i: F.struct(F.lit(kind).alias("BlockType"), text.alias("Text"), (90 + i % 10).cast("double").alias("Confidence"), box(i).alias("Geometry"))
    blocks = F.concat(F.array(block("LINE", F.array_join("w", " "), F.lit(0))), F.transform("w", lambda w, i: block("WORD", w, i)))
    return d.select("item_id", F.to_json(F.struct(blocks.alias("Blocks"))).alias("response"), F.lit(1000).alias("crop_w"), F.lit(2000).alias("crop_h"))


def ocr_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = R.ocr_words(_responses(spark, sf_dir))
    return d.select("item_id", *[F.col(c).cast("long").alias(c) for c in ("word_seq", *SIDES)], "word", "confidence")


def crops_to_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words moved to a page by their crop's origin."""
    w = R.ocr_words(_responses(spark, sf_dir)).select(F.lit(0).alias("page_id"), F.col("item_id").alias("crop_id"), "word_seq", "word", *SIDES)
    crops = table(spark, sf_dir, "benchmark").select(F.lit(0).alias("page_id"), F.col("item_id").alias("crop_id"), (F.col("item_id") % 7 * 100).alias("crop_x"), (F.col("item_id") % 11 * 50).alias("crop_y"))
    return L.to_page(w, crops).select("crop_id", *[F.col(c).cast("long").alias(c) for c in ("word_seq", *SIDES)])


def xml_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout labels made of the supplier table's keys."""
    n = F.col("s_suppkey")
    rect = F.concat_ws(",", n * 100, n * 50, n * 100 + 5000, n * 50 + 7000)
    xml = F.concat(F.lit('<page><particle classification="article"><group><subparticle rect="'), rect, F.lit('"/></group></particle><particle classification="advert"><subparticle rect="1,2,3,4"/></particle></page>'))
    d = table(spark, sf_dir, "supplier").select(n.alias("page_id"), xml.alias("xml"), F.lit(4000).alias("page_w"), F.lit(6000).alias("page_h"))
    return R.layout_boxes(d).select("page_id", *[F.col(c).cast("long").alias(c) for c in ("class_id", "seg_id", *SIDES)])


def crop_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as crops of 3,000 times their length: how many may be sent, by host ending."""
    crops = table(spark, sf_dir, "pages").select(F.substring_index(F.split_part("url", F.lit("/"), F.lit(3)), ".", -1).alias("ending"), (F.length("html").cast("long") * 3000).alias("length"))
    small, large = R.crops_by_size(crops)
    return small.withColumn("sent", F.lit(1)).unionByName(large.withColumn("sent", F.lit(0))).groupBy("ending").agg(F.count("*").alias("n"), F.sum("sent").alias("sent"))


def page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each page in reading order as one JSON array; its length and number of words."""
    j = W.pages_json(L.assign_pages(X.page_rows(spark, sf_dir), ordered=True), F.lit(99).cast("double"))
    return j.select("page_id", F.size(F.from_json("json", "array<struct<word:string>>")).cast("long").alias("n_words"), F.get_json_object("json", "$[0].word").alias("first_word"))


def band_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of one nation whose balances differ by less than 500: a band join on buckets."""
    s = table(spark, sf_dir, "supplier")
    a = s.select("s_nationkey", F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("av"))
    b = s.select("s_nationkey", F.col("s_suppkey").alias("b"), F.col("s_acctbal").alias("bv"))
    return bucketed_band_join(a, b, ["s_nationkey"], "av", "bv", 500).where("a < b").select("a", "b")


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latest_status(X.log(spark, sf_dir), "event_id").select("file_name", "event", "n_events")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.failures(X.log(spark, sf_dir)).select("file_name", "n_errors", F.unix_micros("first_error").alias("first_error_us"))


def load_multiplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.load_multiplier(table(spark, sf_dir, "benchmark").select("item_id"), 100).select("item_id", F.col("copy").cast("long").alias("copy"))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as files, taken in by a stream in small batches; the latest state of what arrived."""
    base = work_path(spark, "stream")
    log = X.log(spark, sf_dir).withColumn("error", F.lit(None).cast("string")).select("file_name", "event", "ts", "error", "event_id")
    log.repartition(4).write.json(f"{base}/in")
    stream = S.stream_log(spark, f"{base}/in", log.schema, files_per_trigger=2)
    S.run_once(stream, f"{base}/out", f"{base}/state")
    S.run_once(stream, f"{base}/out", f"{base}/state")  # a second run finds nothing new
    return S.latest_status(spark.read.schema(log.schema).parquet(f"{base}/out"), "event_id").select("file_name", "event", "n_events")


def box_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment boxes of all pages written as CSV and read back."""
    base = work_path(spark, "boxes")
    W.write_boxes(X.segments(spark, sf_dir), base, "combined", by_page=False)
    back = spark.read.schema(T.StructType([T.StructField("page_id", T.LongType()), *R.BOX.fields])).csv(f"{base}/stage=combined")
    return back.groupBy(F.col("x_min").cast("long").alias("x_min")).agg(F.count("*").alias("n"), F.sum("y_max").alias("y_max"))


QUERIES = {f.__name__: f for f in (json_props, ocr_blocks, crops_to_page, xml_boxes, crop_gate, page_json, band_pairs, latest_status, failures, load_multiplier, stream_ingest, box_files)}

_OCR = """words AS (SELECT item_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM benchmark),
  px AS (SELECT item_id, i + 1 AS word_seq, word, 90 + i % 10::DOUBLE AS confidence, (trunc(1000 * (i % 4 / 4.0::DOUBLE)))::BIGINT AS x_min, (trunc(2000 * (i / 1024.0::DOUBLE)))::BIGINT AS y_min,
    (trunc(1000 * (i % 4 / 4.0::DOUBLE + 0.125::DOUBLE)))::BIGINT AS x_max, (trunc(2000 * (i / 1024.0::DOUBLE + 0.0625::DOUBLE)))::BIGINT AS y_max FROM words)"""
_LAST = f"WITH {X.LOG_SQL} SELECT file_name, arg_max(event, (ts, event_id, event)) AS event, count(*) AS n_events FROM log GROUP BY file_name"
SQL = {
    "json_props": """SELECT event_id, array_to_string(list_sort(list_transform(json_keys(props), lambda k: k || '=' || json_extract_string(props, '$."' || k || '"'))), ';') AS props FROM events""",
    "ocr_blocks": f"WITH {_OCR} SELECT item_id, word_seq, x_min, y_min, x_max, y_max, word, confidence FROM px",
    "crops_to_page": f"WITH {_OCR} SELECT item_id AS crop_id, word_seq, x_min + item_id % 7 * 100 AS x_min, y_min + item_id % 11 * 50 AS y_min, x_max + item_id % 7 * 100 AS x_max, y_max + item_id % 11 * 50 AS y_max FROM px",
    "xml_boxes": """SELECT s_suppkey AS page_id, 1 AS class_id, 0 AS seg_id, CAST(trunc(s_suppkey * 100 / 65535::DOUBLE * 4000) AS BIGINT) AS x_min, CAST(trunc(s_suppkey * 50 / 65535::DOUBLE * 6000) AS BIGINT) AS y_min,
        CAST(trunc((s_suppkey * 100 + 5000) / 65535::DOUBLE * 4000) AS BIGINT) AS x_max, CAST(trunc((s_suppkey * 50 + 7000) / 65535::DOUBLE * 6000) AS BIGINT) AS y_max FROM supplier""",
    "crop_gate": f"""SELECT string_split(string_split(url, '/')[3], '.')[-1] AS ending, count(*) AS n, count(*) FILTER (length(html) * 3000 < {R.MOST_BYTES}) AS sent FROM pages GROUP BY ALL""",
    "page_json": f"""WITH {X.SEGMENTS_SQL}, seg AS (SELECT w.page_id, w.word_seq, w.word, max(s.seg_id) FILTER (greatest(0, least(w.x_max, s.x_max) - greatest(w.x_min, s.x_min) + 1) * greatest(0, least(w.y_max, s.y_max) - greatest(w.y_min, s.y_min) + 1) / ((w.x_max - w.x_min + 1) * (w.y_max - w.y_min + 1)) > {L.INSIDE}) AS inside,
        arg_min(s.seg_id, (sqrt(pow((w.x_min + w.x_max) / 2 - s.x_min, 2) + pow((w.y_min + w.y_max) / 2 - s.y_min, 2)) + sqrt(pow((w.x_min + w.x_max) / 2 - s.x_max, 2) + pow((w.y_min + w.y_max) / 2 - s.y_max, 2)), s.seg_id)) AS near
        FROM words w LEFT JOIN segments s USING (page_id) GROUP BY ALL)
        SELECT page_id, count(*) AS n_words, arg_min(word, (coalesce(inside, near, 1000000000), word_seq)) AS first_word FROM seg GROUP BY page_id""",
    "band_pairs": "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b USING (s_nationkey) WHERE a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) < 500",
    "latest_status": _LAST,
    "failures": f"WITH {X.LOG_SQL} SELECT file_name, count(*) AS n_errors, epoch_us(min(ts)) AS first_error_us FROM log WHERE contains(event, 'error') GROUP BY file_name",
    "load_multiplier": "SELECT item_id, i AS copy FROM benchmark, range(100) r(i)",
    "stream_ingest": _LAST,
    "box_files": f"WITH {X.SEGMENTS_SQL} SELECT x_min, count(*) AS n, sum(y_max)::BIGINT AS y_max FROM segments GROUP BY x_min",
}
