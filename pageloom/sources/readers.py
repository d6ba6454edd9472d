"""Readers: files, texts, boxes, masks, recorded OCR responses, layout labels."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.geometry import SIDES, relative_to_pixels
from pageloom.functions.text import file_stem, keep_key

BOX = T.StructType([T.StructField(s, T.IntegerType()) for s in SIDES])
OCR = T.StructType().add("Blocks", T.ArrayType(
    T.StructType().add("BlockType", "string").add("Text", "string").add("Confidence", "double").add(
        "Geometry", T.StructType().add("BoundingBox", T.StructType().add("Left", "double").add("Top", "double").add("Width", "double").add("Height", "double"))
    )
))
WORD = T.StructType().add("word", "string").add("segment", T.IntegerType()).add("confidence", "double")
for _s in SIDES:
    WORD = WORD.add(_s, T.IntegerType())
WORD = WORD.add("read_order_segment_id", T.IntegerType())
#: Label coordinates are parts of this number; class ids by name. Fixed values.
LABEL_SCALE, CLASSES = 65535, {"article": 1}
#: Largest payload of a crop, in bytes (exclusive).
MOST_BYTES = 10485760


def list_files(spark: SparkSession, folder: str, suffix: str = "", keyword: str = "", level: int | None = None) -> DataFrame:
    """path, length of files below a folder, by ending, keyword and depth below it; contents are not read. Spark's file source leaves empty files out."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    root = F.regexp_replace(F.lit(folder.rstrip("/")), "^file:/*", "/")
    key = F.substring(F.regexp_replace("path", "^file:/*", "/"), F.length(root) + 2, F.lit(1 << 30))
    return d.withColumn("key", key).where(keep_key(F.col("key"), suffix, keyword, level))


def list_folders(files: DataFrame) -> DataFrame:
    """folder: the distinct folders that hold listed files (key)."""
    return files.select(F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("folder")).where("folder <> ''").distinct()


def paths_by_index(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """wanted (id) with path out of an index table (id, path)."""
    return wanted.join(index, "id", "left")


def read_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """page_id (file name up to its first dot), path, length, content."""
    return spark.read.format("binaryFile").load(path).select(file_stem(F.col("path")).alias("page_id"), "path", "length", "content")


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, text of whole files; bytes that are no UTF-8 become replacement characters."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no from 0, line with its line end. A file is read whole by one task, so it must be smaller than 2 GB."""
    d = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    lines = F.filter(F.split("value", r"(?<=\n)"), lambda x: x != "")
    return d.select("file", F.posexplode(lines).alias("line_no", "line"))


def read_boxes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """page_id, seg_id (line number) and sides out of headerless CSV files, one page each."""
    d = read_lines(spark, path)
    parts = F.split(F.trim(F.regexp_replace("line", r"[\r\n]", "")), ",")
    return d.where(F.trim("line") != "").select(file_stem(F.col("file")).alias("page_id"), F.col("line_no").alias("seg_id"), *[F.trim(F.get(parts, F.lit(i))).cast("int").alias(s) for i, s in enumerate(SIDES)])


def read_mask(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """page_id, row, col, prob out of CSV matrices, one page each."""
    d = read_lines(spark, path).select(file_stem(F.col("file")).alias("page_id"), F.col("line_no").alias("row"), F.regexp_replace("line", r"[\r\n]", "").alias("line"))
    return d.where("line <> ''").select("page_id", "row", F.posexplode(F.split("line", ",")).alias("col", "p")).select("page_id", "row", "col", F.col("p").cast("double").alias("prob"))


def read_words(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """page_id, word_seq and the word fields out of JSON arrays, one page each."""
    d = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", T.ArrayType(WORD)).alias("w"))
    return d.select(file_stem(F.col("file")).alias("page_id"), F.posexplode("w").alias("word_seq", "w")).select("page_id", "word_seq", "w.*")


def ocr_words(responses: DataFrame, segment: Column | None = None) -> DataFrame:
    """Words of recorded OCR responses in pixels of their crop.

    responses: any columns and response (JSON), crop_w, crop_h. WORD blocks
    are kept, in the order of the service.
    """
    kept = [c for c in responses.columns if c not in ("response", "crop_w", "crop_h")]
    d = responses.select(*kept, "crop_w", "crop_h", F.posexplode(F.from_json("response", OCR)["Blocks"]).alias("word_seq", "b")).where("b.BlockType = 'WORD'")
    g = F.col("b.Geometry.BoundingBox")
    box = relative_to_pixels(g["Left"], g["Top"], g["Width"], g["Height"], F.col("crop_w"), F.col("crop_h"))
    own = F.lit(None).cast("int") if segment is None else segment
    return d.select(*kept, "word_seq", F.col("b.Text").alias("word"), own.alias("segment"), F.col("b.Confidence").alias("confidence"), *box.named())


def layout_boxes(labels: DataFrame) -> DataFrame:
    """class_id and box of the labelled particles out of layout XML (page_id, xml, page_w, page_h)."""
    out = None
    for name, number in CLASSES.items():
        d = labels.select("page_id", "page_w", "page_h", F.posexplode(F.xpath("xml", F.lit(f"/*/particle[@classification='{name}']//subparticle/@rect"))).alias("seg_id", "rect"))
        p = [F.element_at(F.split("rect", ","), i + 1).cast("double") / LABEL_SCALE for i in range(4)]
        sides = [(p[i] * F.col("page_w" if i % 2 == 0 else "page_h")).cast("int").alias(s) for i, s in enumerate(SIDES)]
        d = d.select("page_id", F.lit(number).alias("class_id"), "seg_id", *sides)
        out = d if out is None else out.unionByName(d)
    return out


def crops_by_size(crops: DataFrame, most: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(crops small enough to be sent, the others), by the column length."""
    small = F.col("length") < most
    return crops.where(small), crops.where(~small | F.col("length").isNull())


def crop_keys(keys: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Keys that start with one of the prefixes, with the place of the first such prefix."""
    place = F.coalesce(*[F.when(F.col("key").startswith(p), F.lit(i)) for i, p in enumerate(prefixes)])
    return keys.withColumn("prefix_no", place).where("prefix_no IS NOT NULL")


def join_by_key(files: DataFrame, truth: DataFrame, key: Column, truth_key: Column) -> DataFrame:
    """files with the first truth file of equal key (columns file, text, ordinal); null without one."""
    t = truth.select(truth_key.alias("_key"), "ordinal", F.col("file").alias("truth_file"), F.col("text").alias("truth"))
    t = t.groupBy("_key").agg(F.min(F.struct("ordinal", "truth_file", "truth")).alias("t")).select("_key", "t.truth_file", "t.truth")
    return files.withColumn("_key", key).join(t, "_key", "left").drop("_key")


class Params:
    """Settings as attributes, kept in a JSON file on the driver."""

    def __init__(self, path: str):
        self.update(path)

    def update(self, path: str) -> None:
        self.__dict__.update(json.loads(Path(path).read_text()))

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(self.__dict__, indent=4))

    @property
    def dict(self) -> dict:
        return self.__dict__
