import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES
from pageloom.operators import evaluate as E
from pageloom.operators import lifecycle as C
from pageloom.sources import readers as R


def grid_rows(page, rects, size=64):
    g = np.zeros((size, size))
    for x0, y0, x1, y1 in rects:
        g[y0:y1, x0:x1] = 0.9
    return [(page, r, c, float(g[r, c])) for r in range(size) for c in range(size)]


def test_from_mask_to_words(spark):
    mask = spark.createDataFrame(grid_rows(1, [(2, 2, 20, 20), (2, 30, 20, 50), (40, 2, 60, 30), (30, 60, 31, 61)]), "page_id long, row int, col int, prob double")
    pages = spark.createDataFrame([(1, 640, 1280)], "page_id long, page_w int, page_h int")
    stages = C.ordered_segments(mask, pages, least_area=20, grid=64)
    raw = [tuple(r[s] for s in SIDES) for r in stages["raw"].orderBy("seg_id").collect()]
    assert raw == [(20, 40, 200, 400), (400, 40, 600, 600), (20, 600, 200, 1000)]
    bbox = [tuple(r[s] for s in SIDES) for r in stages["bbox"].orderBy("seg_id").collect()]
    assert bbox == [(12, 34, 208, 406), (392, 34, 608, 606), (12, 594, 208, 1006)]
    combined = stages["combined"].orderBy("seg_id").collect()
    assert [tuple(r[s] for s in SIDES) for r in combined] == [(12, 34, 208, 1006), (392, 34, 608, 606)]

    block = lambda text, left, top: {"BlockType": "WORD", "Text": text, "Confidence": 9.0, "Geometry": {"BoundingBox": {"Left": left, "Top": top, "Width": 0.2, "Height": 0.02}}}
    responses = spark.createDataFrame(
        [(1, 0, json.dumps({"Blocks": [block("low", 0.1, 0.8), block("top", 0.1, 0.1)]})), (1, 1, json.dumps({"Blocks": [block("right", 0.1, 0.5)]}))], "page_id long, crop_id int, response string"
    )
    words = C.words_in_order(responses, stages["combined"], stages["bbox"]).orderBy("read_pos").collect()
    assert [(w["word"], w["read_order_segment_id"]) for w in words] == [("top", 0), ("right", 1), ("low", 2)]


def test_mask_files(spark):
    values = spark.createDataFrame([(p, r, c, 255 if v else 0) for p, r, c, v in grid_rows(1, [(5, 5, 25, 25), (40, 5, 60, 20)])], "page_id long, row int, col int, value int")
    pages = spark.createDataFrame([(1, 128, 64)], "page_id long, page_w int, page_h int")
    out = C.mask_file_boxes(values, pages, 64, [("open", "square", 2)]).orderBy("x_min").collect()
    assert [tuple(r[s] for s in SIDES) for r in out] == [(10, 5, 48, 24), (80, 5, 118, 19)]


def test_pixels_of_boxes_and_complement(spark):
    px = spark.createDataFrame([(1, r, c, r * 10 + c) for r in range(5) for c in range(5)], "page_id long, row int, col int, label int")
    box = spark.createDataFrame([(1, 0, 1, 2, 3, 4)], "page_id long, seg_id int, x_min int, y_min int, x_max int, y_max int")
    assert sorted((r["row"], r["col"], r["label"]) for r in C.crop_pixels(px, box).collect()) == [(0, 0, 21), (0, 1, 22), (1, 0, 31), (1, 1, 32)]
    assert C.complement(px, 0).where("value = 0").count() == 1


def test_model_is_the_callers(spark):
    images = spark.createDataFrame([("p", bytearray(b"\x07"))], "page_id string, content binary")
    out = C.score_images(images, lambda b: [[b[0] / 10] * 2] * 2, 2).collect()
    assert len(out) == 4 and {r["prob"] for r in out} == {0.7}
    r = spark.range(1).select(C.flip_rows(F.lit(12)).alias("y"), C.round_to_page(F.lit(1), F.lit(256 * 5)).alias("v")).first()
    assert (r["y"], r["v"]) == (500, 2)


def test_evaluation_of_identical_text_is_perfect(spark):
    text = [f"line {i} holds words w{i} v{i} u{i}" for i in range(12)]
    lines = spark.createDataFrame([("f", i, t + "\n") for i, t in enumerate(text)] + [("f", 12, "  \n")], "file string, line_no int, line string")
    truth = E.truth_words(lines)
    blocks = E.line_blocks(lines)
    a = E.edit_accuracy(blocks, truth).first()
    assert a["n_blocks"] == 12 and a["accuracy"] == pytest.approx((a["total"] - 11) / a["total"]) and a["error"] == 0
    assert E.read_order(blocks, truth).first()["accuracy"] == 1.0
    assert E.edit_accuracy(E.word_blocks(truth, 20), truth).first()["error"] == 0


def test_blocks_without_rare_words_lie_nowhere(spark):
    truth = spark.createDataFrame([("f", "a a a a b c d")], "file string, text string")
    lines = spark.createDataFrame([("f", 0, "a a"), ("f", 1, "b c d")], "file string, line_no int, line string")
    got = {r["block_id"]: (r["i_min"], r["i_max"]) for r in E.ranges_of(E.line_blocks(lines), truth).collect()}
    assert got == {0: (-1, -1), 1: (4, 6)}


def test_engines_and_failures(spark):
    d = spark.createDataFrame([("k1", "a b", "a c", "a b"), ("k2", None, "x", "x")], "key string, a string, b string, truth string")
    good, bad = E.compare_engines(d)
    assert {(r["key"], r["metric"]): (r["err_a"], r["err_b"]) for r in good.collect()} == {("k1", "wer"): (0.0, 0.5), ("k1", "lev"): (0.0, 1.0)}
    assert [tuple(r) for r in bad.collect()] == [("k2", "a")]


def test_names_and_paths(spark):
    names = spark.createDataFrame([("x_a", 0), ("b_k", 1), ("c_k", 2)], "name string, ordinal int")
    assert E.find_file(names, "k").first()["name"] == "b_k" and E.find_file(names, "zz").count() == 0 and E.without_keyword(names, "k").count() == 1
    paths = spark.createDataFrame([("r/a/1.txt", 0), ("s/b/2.txt", 1)], "path string, ordinal int")
    assert E.place_of(paths, "q/b/2.txt").first()["place"] == 2 and E.place_of(paths, "q/c/2.txt").count() == 0
    t = E.path_triples(paths).orderBy("key").first()
    assert (t["key"], t["engine_b"]) == ("a/1", "engine_b/a/1.txt")
    texts = spark.createDataFrame([("f", 0, "has <b>"), ("f", 1, "none"), ("g", 0, "<b>")], "file string, ordinal int, text string")
    assert [r["file"] for r in E.files_with(texts, "<b>").collect()] == ["g"]
    keys = spark.createDataFrame([("a/b/c.txt",), ("a/d.txt",), ("e.txt",)], "key string")
    assert sorted(r["folder"] for r in R.list_folders(keys).collect()) == ["a", "a/b"]
    assert R.paths_by_index(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, "p")], "id int, path string")).where("path IS NULL").count() == 1
