import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions import geometry as G
from pageloom.functions.geometry import SIDES, Box
from pageloom.operators import cleanup as C
from pageloom.operators import layout as L
from pageloom.operators.graph import connected_components
from pageloom.operators.joins import bucketed_band_join, grid_join

SCHEMA = "page_id long, seg_id int, x_min int, y_min int, x_max int, y_max int"


def boxes(spark, rows):
    return spark.createDataFrame([(p, i, *b) for p, i, b in rows], SCHEMA)


def sides(rows):
    return [tuple(r[s] for s in SIDES) for r in rows]


def test_assignment_edges(spark):
    segs = boxes(spark, [(1, 0, (0, 0, 99, 99)), (1, 1, (50, 0, 149, 99)), (1, 2, (100000, 0, 100099, 99))])
    words = spark.createDataFrame(
        [(1, 0, "both", 60, 10, 69, 19), (1, 1, "tenth", 149, 10, 158, 19), (1, 2, "stray", 400, 0, 410, 10), (1, 3, "far", 900000, 0, 900010, 10), (2, 0, "nopage", 0, 0, 9, 9)],
        "page_id long, word_seq long, word string, x_min int, y_min int, x_max int, y_max int",
    )
    got = {r["word"]: (r["inside_segment_id"], r["read_order_segment_id"]) for r in L.assign_segments(words, segs).collect()}
    assert got == {"both": (1, 1), "tenth": (None, 1), "stray": (None, 1), "far": (None, None), "nopage": (None, None)}  # exactly a tenth is outside


def test_nearest_tie_takes_the_smaller_segment(spark):
    segs = boxes(spark, [(1, 0, (0, 0, 10, 10)), (1, 1, (0, 200, 10, 210))])
    words = spark.createDataFrame([(1, 0, "w", 0, 100, 10, 110)], "page_id long, word_seq long, word string, x_min int, y_min int, x_max int, y_max int")
    assert L.assign_segments(words, segs).first()["read_order_segment_id"] == 0


def greedy(rest, part=0.05, max_area=None):
    out, rest = [], list(rest)
    while rest:
        pivot, left, ended = rest[0], [], False
        for b in rest[1:]:
            w = ((pivot[2] - pivot[0]) + (b[2] - b[0])) / 2
            hit = not ended and abs(b[0] - pivot[0]) < part * w and abs(b[2] - pivot[2]) < part * w
            grown = (min(b[0], pivot[0]), min(b[1], pivot[1]), max(b[2], pivot[2]), max(b[3], pivot[3]))
            if hit and max_area is not None and (grown[2] - grown[0]) * (grown[3] - grown[1]) > max_area:
                ended, hit = True, False
            if hit:
                pivot = grown
            else:
                left.append(b)
        out.append(pivot)
        rest = left
    return out


@pytest.mark.parametrize("max_area", [None, 4000])
def test_combine_columns_is_the_greedy_fold(spark, max_area):
    rnd = random.Random(3)
    rows = []
    for page in range(60):
        for i in range(rnd.randint(1, 8)):
            x, y = rnd.choice([0, 2, 4, 6, 100]), rnd.randint(0, 50)
            rows.append((page, i, (x, y, x + 60 + rnd.randint(0, 6), y + rnd.randint(1, 30))))
    out = L.combine_columns(boxes(spark, rows), max_area=max_area).orderBy("page_id", "seg_id").collect()
    for page in range(60):
        assert sides([r for r in out if r["page_id"] == page]) == greedy([b for p, _, b in rows if p == page], max_area=max_area)


def test_overlap_of_equal_boxes_deletes_the_later(spark):
    b = boxes(spark, [(1, 0, (0, 0, 10, 10)), (1, 1, (0, 0, 10, 10)), (1, 2, (1, 1, 9, 9)), (2, 0, (0, 0, 10, 10))])
    assert sorted((r["page_id"], r["seg_id"]) for r in C.remove_overlaps(b).collect()) == [(1, 0), (2, 0)]
    assert {(r["inner"], r["outer"]) for r in C.containment_pairs(b).collect()} == {(2, 0), (2, 1)}
    none = boxes(spark, [(1, 0, (0, 0, 5, 5)), (1, 1, (5, 0, 9, 5))])
    assert C.remove_overlaps(none).count() == 2 and C.intersecting_pairs(none).count() == 0


def test_vertical_merge_gaps(spark):
    b = boxes(spark, [(1, 0, (0, 0, 9, 100)), (1, 1, (0, 149, 9, 300)), (1, 2, (0, 350, 9, 400)), (1, 3, (0, 360, 9, 380))])
    out = C.vertical_merge(b).orderBy("y_min").collect()
    assert [(r["y_min"], r["y_max"]) for r in out] == [(0, 300), (350, 380)]  # 49 merges, 50 does not; the last box ends it


def test_modal_width_tie_takes_the_smaller(spark):
    b = boxes(spark, [(1, 0, (0, 0, 250, 9)), (1, 1, (0, 0, 350, 9)), (1, 2, (0, 0, 210, 9)), (1, 3, (0, 0, 410, 9))])
    assert C.modal_width(b).first()["modal_width"] == 200


def test_vertex_clusters(spark):
    b = boxes(spark, [(1, 0, (0, 0, 100, 100)), (1, 1, (0, 110, 103, 200)), (1, 2, (500, 500, 600, 600))])
    out = {r["seg_id"]: tuple(r[s] for s in SIDES) for r in C.cluster_vertices(b, 70).collect()}
    assert out[2] == (500, 500, 600, 600) and out[0] == (0, 0, 101, 105) and out[1] == (0, 105, 103, 200)


def test_components_against_union_find(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(300)] + [(rnd.randint(2000, 2100), rnd.randint(2000, 2100)) for _ in range(60)] + [(5, 5), (7, None)]
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {v: find(v) for v in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_a_star_settles_in_two_rounds(spark):
    edges = spark.range(1, 3000).selectExpr("id AS src", "0L AS dst")
    got = connected_components(edges, max_rounds=3)  # the third finds nothing left
    assert got.count() == 3000 and got.where("component != 0").count() == 0


def test_bucket_joins(spark):
    rnd = random.Random(7)
    a = [(rnd.randint(0, 2), i, rnd.uniform(-20, 20), rnd.uniform(-20, 20)) for i in range(80)]
    left = spark.createDataFrame(a, "p int, i int, x double, y double")
    right = left.select("p", F.col("i").alias("j"), F.col("x").alias("u"), F.col("y").alias("v"))
    got = {(r["i"], r["j"]) for r in bucketed_band_join(left, right, ["p"], "x", "u", 2.5).collect()}
    assert got == {(m[1], n[1]) for m, n in itertools.product(a, a) if m[0] == n[0] and abs(m[2] - n[2]) < 2.5}
    near = grid_join(left, right, ["p"], ("x", "y"), ("u", "v"), 3.0).collect()
    want = [(m[1], n[1]) for m, n in itertools.product(a, a) if m[0] == n[0] and ((m[2] - n[2]) ** 2 + (m[3] - n[3]) ** 2) ** 0.5 < 3]
    assert sorted((r["i"], r["j"]) for r in near) == sorted(want)


def test_align_page_cases():
    b = np.array([[10, 0, 110, 50], [12, 52, 108, 100], [130, 0, 232, 60], [0, 200, 240, 260]])
    out = C.align_page(b, 20, 0.5, 240)
    assert out.tolist() == [[10, 0, 110, 50], [10, 50, 110, 100], [10, 200, 232, 260], [130, 0, 232, 60]]
    assert C.align_page(b[:0], 20, 0.5, 240).shape == (0, 4)
    assert C.align_page(b[3:], 20, 0.5, 240).shape == (1, 4)  # all boxes wide: all stay


def test_merge_small_page_cases():
    big, small = [0, 0, 10, 500], [0, 510, 10, 600]
    assert C.merge_small_page(np.array([small])).tolist() == [small]
    assert C.merge_small_page(np.array([big, small])).tolist() == [[0, 0, 10, 600]]
    assert C.merge_small_page(np.array([small, [0, 640, 10, 1300]])).tolist() == [[0, 510, 10, 1300]]
    both = C.merge_small_page(np.array([[0, 0, 10, 500], [0, 510, 10, 600], [0, 610, 10, 1110]]))
    assert both.tolist() == [[0, 0, 10, 500], [0, 510, 10, 1110]]  # equal neighbours: the next
    assert C.merge_small_page(np.array([big, [0, 600, 10, 700]])).tolist() == [big, [0, 600, 10, 700]]


def test_post_process_runs_on_small_and_large_pages(spark):
    rows = [(1, i, (i % 4 * 300, i // 4 * 450, i % 4 * 300 + 280, i // 4 * 450 + 430)) for i in range(24)] + [(2, 0, (0, 0, 50, 50))]
    out = C.post_process(boxes(spark, rows), 1200, 3000).collect()
    assert {r["page_id"] for r in out} == {1, 2} and all(r["x_min"] < r["x_max"] and r["y_min"] < r["y_max"] for r in out)


def test_boxes_as_columns(spark):
    d = spark.createDataFrame([(0, 0, 10, 10, 5, 5, 15, 15)], "a_x_min int, a_y_min int, a_x_max int, a_y_max int, b_x_min int, b_y_min int, b_x_max int, b_y_max int")
    a, b = C.pair()
    r = d.select(G.iou(a, b).alias("iou"), G.overlap_on_smaller(a, b).alias("s"), G.inclusive_overlap(a, b).alias("i"), a.padded(1000, 1000).struct().alias("p"), a.clamped(8, 20).struct().alias("c"), G.from_corners(a.corners()).struct().alias("k")).first()
    assert r["iou"] == pytest.approx(25 / 175) and r["s"] == 0.25 and r["i"] == pytest.approx(36 / 121)
    assert tuple(r["p"]) == (0, 0, 22, 15) and tuple(r["c"]) == (0, 0, 3, 10) and tuple(r["k"]) == (0, 0, 10, 10)
    assert Box.of().valid is not None
