"""From boxes to words in reading order. Tables hold a page_id; it is the key of every shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES, Box
from pageloom.operators import assign

#: Words farther than this from every segment get none.
SEARCH_RADIUS = 1e5
#: A word lies in a segment if more than this part of it does.
INSIDE = 0.1


def order_segments(boxes: DataFrame, tie: str = "ord") -> DataFrame:
    """seg_id from 0 by (y_min, x_min), ties by the column ``tie``."""
    w = Window.partitionBy("page_id").orderBy("y_min", "x_min", tie)
    return boxes.withColumn("seg_id", F.row_number().over(w) - 1)


def pad_boxes(boxes: DataFrame, width: int, height: int) -> DataFrame:
    return boxes.select(*[c for c in boxes.columns if c not in SIDES], *Box.of().padded(width, height).named())


def combine_columns(boxes: DataFrame, part: float = 0.05, max_area: int | None = None) -> DataFrame:
    """page_id, seg_id, box: greedy union of vertically aligned boxes, in order of seg_id.

    The first box left is a pivot; each later box that is aligned with the
    pivot as grown so far joins it (with ``max_area``, one that would make the
    union larger ends the pivot's scan); then the next box left. This is an
    ordered fold, no closure, so it runs as nested ``aggregate`` over a page's
    boxes: native, and one page is one task's row. Quadratic per page only.
    """
    box = F.struct("seg_id", *SIDES)
    page = boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(box)).alias("all"))
    page = page.select("page_id", F.transform("all", lambda b: F.struct(*[b[s].cast("int").alias(s) for s in SIDES])).alias("all"))

    def part_of(s: Column) -> Box:
        return Box(*[s[k] for k in SIDES])

    def aligned(a: Box, b: Box) -> Column:
        w = (a.width + b.width) / 2
        return (F.abs(a.x_min - b.x_min) < part * w) & (F.abs(a.x_max - b.x_max) < part * w)

    def scan(state: Column, b: Column) -> Column:
        grown = part_of(state["pivot"]).union(part_of(b))
        hit = ~state["ended"] & aligned(part_of(b), part_of(state["pivot"]))
        over = F.lit(False) if max_area is None else grown.area > max_area
        return F.struct(
            F.when(hit & ~over, grown.struct()).otherwise(state["pivot"]).alias("pivot"),
            F.when(hit & ~over, state["left"]).otherwise(F.concat(state["left"], F.array(b))).alias("left"),
            (state["ended"] | (hit & over)).alias("ended"),
        )

    def turn(state: Column, _: Column) -> Column:
        rest = state["rest"]
        begin = F.struct(rest[0].alias("pivot"), F.slice(rest, 1, 0).alias("left"), F.lit(False).alias("ended"))
        done = F.aggregate(F.slice(rest, 2, F.size(rest)), begin, scan)
        next_ = F.struct(done["left"].alias("rest"), F.concat(state["out"], F.array(done["pivot"])).alias("out"))
        return F.when(F.size(rest) > 0, next_).otherwise(state)

    start = F.struct(F.col("all").alias("rest"), F.slice("all", 1, 0).alias("out"))
    out = page.select("page_id", F.posexplode(F.aggregate("all", start, turn)["out"]).alias("seg_id", "b"))
    return out.select("page_id", "seg_id", *[F.col(f"b.{s}").alias(s) for s in SIDES])


def assign_pages(pages: DataFrame, ordered: bool = False) -> DataFrame:
    """``assign_segments`` of pages that come as a row each, with arrays ``words`` and ``segs`` (``assign.assign_pages``)."""
    return assign.assign_pages(pages, INSIDE, SEARCH_RADIUS, ordered)


def assign_segments(words: DataFrame, segments: DataFrame) -> DataFrame:
    """words with inside_segment_id and read_order_segment_id.

    The last of the segments that hold more than INSIDE of the word; else the
    nearest one by the mean distance of the word's centre to two corners, the
    first of equally near ones, within SEARCH_RADIUS; else null. A page's words
    and segments (bounded lists) meet as arrays, in one join by page. words:
    page_id, word_seq, box.
    """
    lists = lambda d, *columns: F.collect_list(F.struct(*[c for c in columns or d.columns if c != "page_id"]))
    segs = segments.groupBy("page_id").agg(F.array_sort(lists(segments, "seg_id", *SIDES)).alias("segs"))
    pages = words.groupBy("page_id").agg(lists(words).alias("words")).join(segs, "page_id", "left")
    return assign.each_word(assign_pages(pages), *[c for c in words.columns if c != "page_id"], "inside_segment_id", "read_order_segment_id").select(*words.columns, "inside_segment_id", "read_order_segment_id")


def read_order(words: DataFrame) -> DataFrame:
    """read_pos from 0 by (read_order_segment_id, word_seq) within a page; words without a segment last."""
    w = Window.partitionBy("page_id").orderBy(F.col("read_order_segment_id").asc_nulls_last(), "word_seq")
    return words.withColumn("read_pos", F.row_number().over(w) - 1)


def segment_text(words: DataFrame, by: str = "read_order_segment_id") -> DataFrame:
    """A segment's words joined by blanks in their order."""
    ordered = F.array_sort(F.collect_list(F.struct("word_seq", "word")))
    return words.groupBy("page_id", by).agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("text"))


def word_lines(words: DataFrame) -> DataFrame:
    """The unquoted line of each word; a comma in a word shifts the fields of readers, as it always has."""
    fields = ["word", "read_order_segment_id", "confidence", *SIDES]
    return words.withColumn("line", F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in fields]))


def to_page(words: DataFrame, crops: DataFrame) -> DataFrame:
    """Word boxes within crops, moved to page coordinates by the crops' origins (page_id, crop_id, crop_x, crop_y)."""
    d = words.join(crops.select("page_id", "crop_id", "crop_x", "crop_y"), ["page_id", "crop_id"])
    return d.select(*[c for c in words.columns if c not in SIDES], *Box.of().moved(F.col("crop_x"), F.col("crop_y")).named())
