"""Words and segments of pages that come as a row each: a word's segment, and the reading order, in NumPy over many pages at once.

A row per page keeps what belongs together in one place: no word is joined,
sent or sorted by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.geometry import SIDES

#: Words of this many are worked on at once (one page more at most).
_AT_ONCE = 1 << 16


def segments_of(words: np.ndarray, n_words: np.ndarray, segs: np.ndarray, n_segs: np.ndarray, inside_part: float, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Of every word the segment that holds it, and that one or else the nearest; places in ``segs``, -1 for none.

    words and segs: float sides [4, n], page by page, segments in order; a side that is not a number fits nothing.
    """
    at, many = np.repeat(np.cumsum(n_segs) - n_segs, n_words), np.repeat(n_segs, n_words)
    most = int(n_segs.max(initial=0))
    inside = np.full(len(at), -1)
    x0, y0, x1, y1 = words
    area = (x1 - x0 + 1) * (y1 - y0 + 1)
    with np.errstate(all="ignore"):
        for j in range(most):
            mine = np.flatnonzero(many > j)
            s = at[mine] + j
            w = np.maximum(np.minimum(x1[mine], segs[2][s]) - np.maximum(x0[mine], segs[0][s]) + 1, 0)
            h = np.maximum(np.minimum(y1[mine], segs[3][s]) - np.maximum(y0[mine], segs[1][s]) + 1, 0)
            hit = np.flatnonzero(w * h / area[mine] > inside_part)
            inside[mine[hit]] = s[hit]
        read, rest = inside.copy(), np.flatnonzero(inside < 0)
        cx, cy = (x0[rest] + x1[rest]) / 2, (y0[rest] + y1[rest]) / 2
        best = np.full(len(rest), float(radius))
        for j in range(most):
            mine = np.flatnonzero(many[rest] > j)
            s = at[rest[mine]] + j
            reach = lambda kx, ky, mine=mine, s=s: np.sqrt((cx[mine] - segs[kx][s]) * (cx[mine] - segs[kx][s]) + (cy[mine] - segs[ky][s]) * (cy[mine] - segs[ky][s]))
            far = (reach(0, 1) + reach(2, 3)) / 2
            hit = np.flatnonzero(far < best[mine])
            best[mine[hit]] = far[hit]
            read[rest[mine[hit]]] = s[hit]
    return inside, read


def _sides(boxes: pa.StructArray) -> np.ndarray:
    return np.stack([boxes.field(s).cast(pa.float64()).to_numpy(zero_copy_only=False) for s in SIDES])


def _worker(inside_part: float, radius: float, ordered: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(b: pa.RecordBatch) -> pa.RecordBatch:
        counts = [pc.fill_null(pc.list_value_length(b.column(c)), 0).to_numpy() for c in ("words", "segs")]
        words, segs = b.column("words").flatten(), b.column("segs").flatten()
        inside, read = segments_of(_sides(words), counts[0], _sides(segs), counts[1], inside_part, radius)
        ids = segs.field("seg_id")
        found = [ids.take(pa.array(k, pa.int64(), mask=k < 0)) for k in (inside, read)]
        fields, names = [words.field(i) for i in range(words.type.num_fields)], [f.name for f in words.type]
        made = pa.StructArray.from_arrays([*fields, *found], [*names, "inside_segment_id", "read_order_segment_id"])
        if ordered:
            page = np.repeat(np.arange(b.num_rows), counts[0])
            key = pc.fill_null(found[1], 0).to_numpy(zero_copy_only=False)
            made = made.take(pa.array(np.lexsort((words.field("word_seq").to_numpy(zero_copy_only=False), key, read < 0, page))))
        ends = np.concatenate([[0], np.cumsum(counts[0])]).astype(np.int32)
        kept = [c for c in b.schema.names if c not in ("words", "segs")]
        return pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.ListArray.from_arrays(pa.array(ends), made)], names=[*kept, "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.cumsum(pc.fill_null(pc.list_value_length(b.column("words")), 0).to_numpy()) // _AT_ONCE
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield work(b.slice(lo, hi - lo))

    return run


def assign_pages(pages: DataFrame, inside_part: float, radius: float, ordered: bool = False) -> DataFrame:
    """The same pages, their words with inside_segment_id and read_order_segment_id (see ``layout.assign_segments``).

    pages: ``words``, an array of structs that hold word_seq and sides, and ``segs``, an array of (seg_id, sides) in order of
    seg_id, which is left out; any other columns. ``ordered``: words come in reading order, those without a segment last.
    """
    d = pages.select(*[c for c in pages.columns if c not in ("words", "segs")], "words", "segs")
    word, kind = d.schema["words"].dataType.elementType, d.schema["segs"].dataType.elementType["seg_id"].dataType
    word = T.StructType([*word.fields, T.StructField("inside_segment_id", kind), T.StructField("read_order_segment_id", kind)])
    schema = T.StructType([*[f for f in d.schema.fields if f.name not in ("words", "segs")], T.StructField("words", T.ArrayType(word))])
    return d.mapInArrow(_worker(inside_part, radius, ordered), schema)


def each_word(pages: DataFrame, *columns: str) -> DataFrame:
    """A row per word of such pages: page_id and ``columns``; read_pos is its place."""
    d = pages.select("page_id", F.posexplode("words").alias("read_pos", "w"))
    return d.select("page_id", *[F.col(c) if c == "read_pos" else F.col(f"w.{c}") for c in columns])
