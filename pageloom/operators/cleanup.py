"""Repair of boxes: overlaps, corners that nearly meet, columns, small boxes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES, Box, contains_strictly, intersects, iou, overlap_on_smaller
from pageloom.operators.joins import grid_join

BOXES = "page_id {}, seg_id int, x_min int, y_min int, x_max int, y_max int"


def box_pairs(boxes: DataFrame, ordered: bool = False) -> DataFrame:
    """Pairs i, j of one page, i before j (or all i, j that differ): an equi-join by page."""
    a = boxes.select("page_id", F.col("seg_id").alias("i"), *[F.col(s).alias("a_" + s) for s in SIDES])
    b = boxes.select("page_id", F.col("seg_id").alias("j"), *[F.col(s).alias("b_" + s) for s in SIDES])
    return a.join(b, "page_id").where("i <> j" if ordered else "i < j")


def pair() -> tuple[Box, Box]:
    """The boxes i and j of a row of ``box_pairs``."""
    return Box.of("a_"), Box.of("b_")


def overlap_pairs(boxes: DataFrame, ratio: float = 0.8) -> DataFrame:
    """page_id, smaller, larger, ratio of pairs that share more than ``ratio`` of the smaller; of equal ones j counts as smaller."""
    a, b = pair()
    r = overlap_on_smaller(a, b)
    first = a.area < b.area
    d = box_pairs(boxes).where(r > ratio)
    return d.select("page_id", F.when(first, F.col("i")).otherwise(F.col("j")).alias("smaller"), F.when(first, F.col("j")).otherwise(F.col("i")).alias("larger"), r.alias("ratio"))


def remove_overlaps(boxes: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Boxes that are no pair's smaller one; all pairs of the given boxes count, in one pass."""
    gone = overlap_pairs(boxes, ratio).select("page_id", F.col("smaller").alias("seg_id")).distinct()
    return boxes.join(gone, ["page_id", "seg_id"], "left_anti")


def iou_pairs(boxes: DataFrame) -> DataFrame:
    v = iou(*pair())
    return box_pairs(boxes).where(v != 0).select("page_id", "i", "j", v.alias("iou"))


def containment_pairs(boxes: DataFrame) -> DataFrame:
    """page_id, inner, outer with every corner of inner strictly inside outer."""
    return box_pairs(boxes, ordered=True).where(contains_strictly(*pair()[::-1])).select("page_id", F.col("i").alias("inner"), F.col("j").alias("outer"))


def intersecting_pairs(boxes: DataFrame) -> DataFrame:
    return box_pairs(boxes).where(intersects(*pair())).select("page_id", "i", "j")


def corner_rows(boxes: DataFrame) -> DataFrame:
    d = boxes.select("page_id", "seg_id", F.posexplode(Box.of().corners()).alias("corner", "p"))
    return d.select("page_id", "seg_id", "corner", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def vertex_edges(boxes: DataFrame, radius: float = 70) -> DataFrame:
    """Corners of different boxes nearer than ``radius``, equal points left out; a grid join, not all corners."""
    c = corner_rows(boxes)
    a = c.select("page_id", F.col("seg_id").alias("i"), F.col("corner").alias("ci"), F.col("x").alias("xi"), F.col("y").alias("yi"))
    b = c.select("page_id", F.col("seg_id").alias("j"), F.col("corner").alias("cj"), F.col("x").alias("xj"), F.col("y").alias("yj"))
    met = grid_join(a, b, ["page_id"], ("xi", "yi"), ("xj", "yj"), radius)
    return met.where("i < j AND NOT (xi = xj AND yi = yj)")


def clamp_and_validate(boxes: DataFrame, width: int, height: int) -> DataFrame:
    kept = [c for c in boxes.columns if c not in SIDES]
    return boxes.select(*kept, *Box.of().clamped(width, height).named()).where(Box.of().valid)


def modal_width(boxes: DataFrame) -> DataFrame:
    """page_id, modal_width: the commonest width in hundreds (half to even), the smallest of equally common ones."""
    w = boxes.groupBy("page_id", F.bround(Box.of().width.cast("int"), -2).cast("int").alias("w")).agg(F.count("*").alias("n"))
    return w.groupBy("page_id").agg(F.max(F.struct("n", (-F.col("w")).alias("w")))["w"].alias("neg")).select("page_id", (-F.col("neg")).alias("modal_width"))


def read_order_thresholds(boxes: DataFrame, page_width: int) -> DataFrame:
    """page_id, thresh (0.8 of the modal width, rounded half to even) and wide_part (1.1 of it, over the page's width)."""
    m = modal_width(boxes)
    return m.select("page_id", F.bround(0.8 * F.col("modal_width"), 0).alias("thresh"), (1.1 * F.col("modal_width") / page_width).alias("wide_part"))


def vertical_merge(boxes: DataFrame, gap: int = 50) -> DataFrame:
    """Boxes of equal x_min and x_max that follow each other within ``gap``, as one.

    Islands by a lag: a box starts one if it is ``gap`` or more away from the
    box before it. A merged box ends where its last box ends.
    """
    w = Window.partitionBy("page_id", "x_min", "x_max").orderBy("y_min", "y_max", "seg_id")
    d = boxes.withColumn("starts", F.coalesce(F.abs(F.col("y_min") - F.lag("y_max").over(w)) >= gap, F.lit(True)).cast("int"))
    d = d.withColumn("island", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.struct("y_min", "y_max", "seg_id")
    return d.groupBy("page_id", "x_min", "x_max", "island").agg(F.min("y_min").alias("y_min"), F.max(own)["y_max"].alias("y_max"), F.count("*").alias("merged")).drop("island")


# Ordered folds over one page's boxes, which no relational form expresses.


def align_page(boxes: np.ndarray, thresh: float, wide_part: float, page_width: int) -> np.ndarray:
    """One page's boxes in read order, their sides snapped to common column edges.

    ``boxes`` are whole numbers [n, 4]. Rows are worked on by index, and two
    list places may hold one index: boxes that share a snapped corner stand
    for the last of them.
    """
    box = boxes.astype(np.float64).copy()
    if not len(box):
        return box
    two_thirds = thresh * 2 / 3
    is_wide = np.abs(box[:, 2] - box[:, 0]) > wide_part * page_width
    wide = np.flatnonzero(is_wide).tolist()
    at_corner = {(box[i, 0], box[i, 1]): i for i in np.flatnonzero(~is_wide).tolist()}
    at_corner = at_corner or {(box[i, 0], box[i, 1]): i for i in range(len(box))}

    corners = sorted(at_corner)
    lefts: list[float] = []
    for x, _ in corners:
        if not lefts or abs(x - lefts[-1]) > thresh:
            lefts.append(x)
        else:
            lefts[-1] = min(lefts[-1], x)

    snapped: list[tuple[float, float]] = []
    source: dict[tuple[float, float], tuple[float, float]] = {}
    for x, y in corners:
        edge = next((e for e in lefts if abs(x - e) < thresh), None)
        if edge is not None:
            snapped.append((edge, y))
            source[edge, y] = (x, y)
    if not snapped:
        return box[:0]
    order = []
    rights: list[float] = []
    for place in sorted(snapped):
        i = at_corner[source[place]]
        box[i, 0] = place[0]
        order.append(i)
        if rights and abs(box[i, 2] - rights[-1]) <= two_thirds:
            rights[-1] = max(rights[-1], box[i, 2])
        else:
            rights.append(box[i, 2])

    def by_corner(places: list[int]) -> list[int]:
        return sorted(places, key=lambda i: (box[i, 0], box[i, 1]))

    def snap(i: int, side: int, edges: list[float]) -> None:
        for e in edges:
            if abs(box[i, side] - e) < two_thirds:
                box[i, side] = e

    order = by_corner(order)
    for i in order:
        snap(i, 2, rights)
    order = by_corner(order)
    for before, i in zip(order, order[1:], strict=False):
        dx = abs(box[i, 0] - box[before, 0])
        if dx < thresh / 5 and abs(box[i, 1] - box[before, 3]) < thresh / 4:
            box[i, :3] = box[before, 0], box[before, 3], box[before, 2]
        elif dx < thresh / 10:
            box[i, 0], box[i, 2] = box[before, 0], box[before, 2]
        elif abs(box[i, 0] - box[before, 2]) < thresh / 5:
            box[i, 0] = box[before, 2]
    for i in wide:
        snap(i, 0, lefts)
        snap(i, 2, rights)
    return box[by_corner(order if len(at_corner) == len(box) else order + wide)]


def merge_small_page(boxes: np.ndarray, least_height: float = 400, gap: float = 100) -> np.ndarray:
    """One page's boxes with those lower than ``least_height`` joined to a neighbour.

    A neighbour in order has the same sides and lies within ``gap``; of two
    the lower one is taken, the next if they are equal. A box alone stays.
    """
    rows = [list(map(float, r)) for r in boxes]
    at = 0
    while at < len(rows):
        cur = rows[at]
        if cur[3] - cur[1] >= least_height:
            at += 1
            continue

        def fits(upper: list[float], lower: list[float]) -> bool:
            return upper[0] == lower[0] and upper[2] == lower[2] and lower[1] - upper[3] < gap

        before = rows[at - 1] if at > 0 and fits(rows[at - 1], cur) else None
        after = rows[at + 1] if at + 1 < len(rows) and fits(cur, rows[at + 1]) else None
        if before and after:
            if before[3] - before[1] >= after[3] - after[1]:
                before = None
            else:
                after = None
        if before:
            before[3] = cur[3]
            del rows[at]
            at -= 1
        elif after:
            after[1] = cur[1]
            del rows[at]
        else:
            at += 1
    return np.array(rows).reshape(-1, 4)


def cluster_corners(page: np.ndarray, boxes: np.ndarray, radius: float = 70) -> np.ndarray:
    """Sides [n, 4] of boxes of many pages, rebuilt from corners that moved to their cluster's mean, cut to whole pixels.

    ``page`` ascends. Clusters are what links of ``vertex_edges`` join, union-find over all corners at once; corners on
    their own stay. Neighbours are found in cells of ``radius``.
    """
    n = len(boxes)
    if not n:
        return boxes
    x, y = (boxes[:, k].astype(np.float64).ravel() for k in ([0, 0, 2, 2], [1, 3, 3, 1]))
    box = np.repeat(np.arange(n), 4)
    cx, cy = (np.floor(v / radius).astype(np.int64) for v in (x, y))
    place = np.stack([page[box], cx, cy], axis=1)
    order = np.lexsort((cy, cx, place[:, 0]))
    same = np.concatenate([[False], (place[order][1:] == place[order][:-1]).all(axis=1)])
    starts = np.flatnonzero(~same)
    sizes = np.diff([*starts, 4 * n])
    where = {tuple(p): k for k, p in enumerate(place[order[starts]].tolist())}
    near = [(k, where.get((p, u + du, v + dv))) for (p, u, v), k in where.items() for du, dv in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]
    left, right = (np.array(v, np.int64) for v in zip(*[c for c in near if c[1] is not None], strict=True))
    parent = list(range(4 * n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # All corners of two neighbouring cells, as pairs, some at a time.
    ends = np.cumsum(sizes[left] * sizes[right])
    linked = np.zeros(4 * n, bool)
    for lo in range(0, int(ends[-1]), 1 << 20):
        nth = np.arange(lo, min(lo + (1 << 20), int(ends[-1])))
        k = np.searchsorted(ends, nth, "right")
        nth = ends[k] - 1 - nth
        a, b = order[starts[left[k]] + nth // sizes[right[k]]], order[starts[right[k]] + nth % sizes[right[k]]]
        dx, dy = x[a] - x[b], y[a] - y[b]
        met = (box[a] != box[b]) & ((dx != 0) | (dy != 0)) & (np.sqrt(dx * dx + dy * dy) < radius)
        linked[a[met]] = linked[b[met]] = True
        for i, j in zip(a[met].tolist(), b[met].tolist(), strict=True):
            i, j = root(i), root(j)
            if i != j:
                parent[max(i, j)] = min(i, j)
    moved = np.flatnonzero(linked)
    roots = np.array([root(i) for i in moved.tolist()], np.int64)
    count = np.bincount(roots, minlength=4 * n)[roots] if len(roots) else np.zeros(0)
    for v in (x, y):
        if len(roots):
            v[moved] = np.trunc(np.bincount(roots, v[moved], 4 * n)[roots] / count)
    return np.stack([x[0::4], y[0::4], x[2::4], y[2::4]], axis=1).astype(np.int64)


def _whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by page as tables of whole pages, with the places where a page begins and the last one ends."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        t = pa.Table.from_batches([*held, b])
        page = t.column("page_id").to_numpy()
        cuts = [0, *(np.flatnonzero(page[1:] != page[:-1]) + 1).tolist()]
        if len(cuts) > 1:
            yield t.slice(0, cuts[-1]), cuts
        held = t.slice(cuts[-1]).to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, [0, t.num_rows]


def cluster_vertices(boxes: DataFrame, radius: float = 70) -> DataFrame:
    """Boxes rebuilt from corners that moved to their cluster's mean, cut to whole pixels.

    Clusters are the connected components of ``vertex_edges``; corners on their
    own stay. A box is taken from its first and third corner. Corners of
    different pages never meet, so boxes come together page by page, in one shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cuts in _whole_pages(batches):
            page = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
            out = cluster_corners(page, np.stack([t.column(s).to_numpy() for s in SIDES], axis=1), radius).astype(np.int32)
            kept = t.select(["page_id", "seg_id"]).combine_chunks().to_batches()[0]
            yield pa.record_batch([*kept.columns, *[pa.array(out[:, k].copy()) for k in range(4)]], names=["page_id", "seg_id", *SIDES])

    d = boxes.select("page_id", "seg_id", *SIDES)
    types = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = f"page_id {types['page_id']}, seg_id {types['seg_id']}, " + ", ".join(f"{s} int" for s in SIDES)
    return d.repartition("page_id").sortWithinPartitions("page_id", "seg_id").mapInArrow(run, schema)


def _per_page(boxes: DataFrame, fold: Callable[..., np.ndarray], extra: tuple[str, ...] = ()) -> DataFrame:
    """``fold`` of each page's sides in order of seg_id (and of the first row's extra columns), numbered anew.

    Pages are streamed through sorted partitions, not handed over one by one:
    a page costs its fold, no data frame.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def folded(t: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            page = t.column("page_id").to_numpy()
            sides = np.stack([t.column(s).to_numpy() for s in SIDES], axis=1)
            more = [t.column(c).to_numpy() for c in extra]
            made = [fold(sides[lo:hi], *[m[lo] for m in more]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            n = np.array([len(m) for m in made], np.int64)
            out = np.concatenate([np.zeros((0, 4)), *made]).astype(np.int32)
            number = np.arange(len(out)) - np.repeat(np.cumsum(n) - n, n)
            return pa.record_batch([pa.array(np.repeat(page[cuts[:-1]], n), t.schema.field("page_id").type), pa.array(number.astype(np.int32)), *[pa.array(out[:, k].copy()) for k in range(4)]], names=["page_id", "seg_id", *SIDES])

        for t, cuts in _whole_pages(batches):
            yield folded(t, cuts)

    d = boxes.select("page_id", "seg_id", *SIDES, *extra)
    return d.repartition("page_id").sortWithinPartitions("page_id", "seg_id").mapInArrow(run, BOXES.format(d.schema["page_id"].dataType.simpleString()))


def page_thresholds(boxes: np.ndarray, page_width: int) -> tuple[float, float]:
    """``read_order_thresholds`` of one page."""
    widths, n = np.unique(np.rint((boxes[:, 2] - boxes[:, 0]) / 100) * 100, return_counts=True)
    modal = float(widths[np.argmax(n)])
    return float(np.rint(0.8 * modal)), 1.1 * modal / page_width


def align_read_order(boxes: DataFrame, page_width: int, thresh: float | None = None, wide_part: float | None = None) -> DataFrame:
    """``align_page`` over every page; thresholds are given, or come from the page's own modal width."""
    if thresh is not None and wide_part is not None:
        return _per_page(boxes, lambda b: align_page(b, thresh, wide_part, page_width))
    return _per_page(boxes, lambda b: align_page(b, *page_thresholds(b, page_width), page_width))


def merge_small_boxes(boxes: DataFrame, least_height: float = 400, gap: float = 100) -> DataFrame:
    return _per_page(boxes, lambda b: merge_small_page(b, least_height, gap))


def overlapped(boxes: np.ndarray, ratio: float = 0.8) -> np.ndarray:
    """Which of one page's boxes ``remove_overlaps`` takes out."""
    b = boxes.astype(np.int64)
    w = np.minimum(b[:, None, 2], b[:, 2]) - np.maximum(b[:, None, 0], b[:, 0])
    h = np.minimum(b[:, None, 3], b[:, 3]) - np.maximum(b[:, None, 1], b[:, 1])
    area = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    valid = (b[:, 0] < b[:, 2]) & (b[:, 1] < b[:, 3])
    with np.errstate(all="ignore"):
        over = np.maximum(w, 0) * np.maximum(h, 0) / np.minimum(area[:, None], area) > ratio
    over &= valid[:, None] & valid
    n = np.arange(len(b))
    # The smaller one goes, of equal ones the later.
    return (over & ((area[:, None] < area) | ((area[:, None] == area) & (n[:, None] > n)))).any(axis=1)


def vertical_merge_page(boxes: np.ndarray, gap: int = 50) -> np.ndarray:
    """``vertical_merge`` of one page's boxes, in order of their sides."""
    out: list[list[int]] = []
    for i in np.lexsort((np.arange(len(boxes)), boxes[:, 3], boxes[:, 1], boxes[:, 2], boxes[:, 0])).tolist():
        x0, y0, x1, y1 = boxes[i].tolist()
        if out and (out[-1][0], out[-1][2]) == (x0, x1) and abs(y0 - out[-1][3]) < gap:
            out[-1][3] = y1
        else:
            out.append([x0, y0, x1, y1])
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def post_process(boxes: DataFrame, page_width: int, page_height: int) -> DataFrame:
    """Overlaps out; read order and small boxes on pages of more than 6; corners clustered; columns merged on pages of more than 16; clamped and valid.

    All steps stay within a page, so boxes come together page by page once, and no step is a join or a shuffle of its own.
    """
    def numbered(ids: np.ndarray, b: np.ndarray, most: int, fold: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if len(b) <= most:
            return ids, b
        out = fold(b).astype(np.int32).astype(np.int64)
        return np.arange(len(out)), out

    def first(b: np.ndarray) -> np.ndarray:
        return merge_small_page(align_page(b, *page_thresholds(b, page_width), page_width))

    def last(b: np.ndarray) -> np.ndarray:
        return vertical_merge_page(align_page(b, 250, 0.3, 5000).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cuts in _whole_pages(batches):
            sides = np.stack([t.column(s).to_numpy() for s in SIDES], axis=1).astype(np.int64)
            ids = t.column("seg_id").to_numpy().astype(np.int64)
            made = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                kept = ~overlapped(sides[lo:hi])
                made.append(numbered(ids[lo:hi][kept], sides[lo:hi][kept], 6, first))
            n = np.array([len(i) for i, _ in made])
            moved = cluster_corners(np.repeat(np.arange(len(n)), n), np.concatenate([b for _, b in made]))
            made = [numbered(i, b, 16, last) for (i, _), b in zip(made, np.split(moved, np.cumsum(n)[:-1]), strict=True)]
            page = np.repeat(np.array(cuts[:-1]), [len(i) for i, _ in made])
            out = np.concatenate([b for _, b in made]).astype(np.int32)
            kept = t.column("page_id").combine_chunks().take(pa.array(page))
            number = np.concatenate([i for i, _ in made]).astype(np.int32)
            yield pa.record_batch([kept, pa.array(number), *[pa.array(out[:, k].copy()) for k in range(4)]], names=["page_id", "seg_id", *SIDES])

    d = boxes.select("page_id", "seg_id", *SIDES)
    d = d.repartition("page_id").sortWithinPartitions("page_id", "seg_id").mapInArrow(run, BOXES.format(d.schema["page_id"].dataType.simpleString()))
    return clamp_and_validate(d, page_width, page_height)
