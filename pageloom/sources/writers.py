"""Writers: lines, JSON per page, boxes, words, scores."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES
from pageloom.operators.layout import word_lines
from pageloom.session import materialize


def write_lines(lines: DataFrame, path: str, line: str = "line", mode: str = "overwrite") -> None:
    """Text lines; an array column's parts are joined by blanks."""
    column = F.array_join(line, " ") if dict(lines.dtypes)[line].startswith("array") else F.col(line).cast("string")
    lines.select(column.alias("value")).write.mode(mode).text(path)


def append_scores(scores: DataFrame, path: str, *columns: str) -> None:
    """``file,score`` lines added to what is there."""
    scores.select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value")).write.mode("append").text(path)


_FIELDS = ("word", "segment", "confidence", *SIDES, "read_order_segment_id")


def words_json(words: DataFrame) -> DataFrame:
    """page_id, json: a page's words in reading order as one array."""
    names = [c for c in _FIELDS if c in words.columns]
    rows = F.array_sort(F.collect_list(F.struct("read_pos", F.struct(*names).alias("w"))))
    return words.groupBy("page_id").agg(F.to_json(F.transform(rows, lambda r: r["w"])).alias("json"))


def pages_json(pages: DataFrame, confidence: Column) -> DataFrame:
    """The same of pages that come as a row each, their words in reading order (``layout.assign_pages``)."""
    own = pages.schema["words"].dataType.elementType.names
    fields = lambda w: [confidence.alias(c) if c == "confidence" else w[c].alias(c) for c in _FIELDS if c == "confidence" or c in own]
    return pages.select("page_id", F.to_json(F.transform("words", lambda w: F.struct(*fields(w)))).alias("json"))


def write_words(words: DataFrame, path: str, quoted: bool = False) -> None:
    """Words in reading order, partitioned by page: the unquoted lines, or (``quoted``) real CSV."""
    if quoted:
        d = words.repartition("page_id").sortWithinPartitions("page_id", "read_pos")
        d.select("page_id", "word", "read_order_segment_id", "confidence", *SIDES).write.mode("overwrite").partitionBy("page_id").csv(path)
    else:
        d = word_lines(words).repartition("page_id").sortWithinPartitions("page_id", "read_pos")
        d.select("page_id", F.col("line").alias("value")).write.mode("overwrite").partitionBy("page_id").text(path)


def write_boxes(boxes: DataFrame, path: str, stage: str, by_page: bool = True) -> None:
    """Headerless whole-number CSV below ``path``/stage=<stage>, in order of seg_id.

    ``by_page``: a folder page_id=<page> for each page. Without it pages share
    files, each line beginning with its page: for more pages than a file
    system can bear as folders.
    """
    d = boxes.repartition("page_id").sortWithinPartitions("page_id", "seg_id")
    if not by_page:
        d.select("page_id", *[F.col(s).cast("int") for s in SIDES]).write.mode("overwrite").csv(f"{path}/stage={stage}")
        return
    d.select("page_id", *[F.col(s).cast("int") for s in SIDES]).write.mode("overwrite").partitionBy("page_id").csv(f"{path}/stage={stage}")


def output_names(image_path: Column) -> tuple[Column, Column]:
    """Names of a page's text and JSON outputs: the image's path up to its ending."""
    stem = F.regexp_replace(image_path, r"\.[^./]*$", "")
    return F.concat(stem, F.lit(".txt")), F.concat(stem, F.lit(".json"))


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Each row (name, content) as a file below ``folder``; gives name, ok and the error of those that failed.

    name may hold folders; a file whose name ends in .gz is packed. A file is written under a name of its own and then renamed, so a
    task that runs again leaves one whole file. One row that fails is a row of the result, not
    the end of the others. The folder's scheme is what Hadoop's default file system says where it has none.
    """
    jvm, conf = files.sparkSession.sparkContext._jvm, files.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(conf).makeQualified(path).toUri().toString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        scheme, rest = uri.split(":", 1)
        store, root = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")
        for b in batches:
            errors: list[str | None] = []
            for name, content in zip(b.column("name").to_pylist(), b.column("content"), strict=True):
                try:
                    whole = f"{root}/{name}"
                    store.create_dir(whole.rsplit("/", 1)[0], recursive=True)
                    own = f"{whole.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                    with store.open_output_stream(own) as f:
                        f.write(gzip.compress(content.as_py(), 1, mtime=0) if name.endswith(".gz") else content.as_buffer())
                    store.move(own, whole)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 (any failure is the row's result)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.record_batch([b.column("name"), pa.array([e is None for e in errors]), pa.array(errors, pa.string())], names=["name", "ok", "error"])

    return materialize(files.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(run, "name string, ok boolean, error string"), "written")


def copy_files(files: DataFrame, folder: str) -> DataFrame:
    """Read files (key, content) once more below another folder; gives what ``write_files`` gives."""
    return write_files(files.select(F.col("key").alias("name"), "content"), folder)
