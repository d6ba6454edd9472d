import json

import pytest
from pyspark.sql import functions as F

from pageloom.operators import layout as L
from pageloom.sources import readers as R
from pageloom.sources import writers as W
from pageloom.streaming import tasks as S


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "p1.x.txt").write_text("one\ntwo\n\nlast")
    (tmp_path / "a" / "b" / "p2.txt").write_bytes(b"bad \xff byte")
    (tmp_path / "a" / "b" / "box.csv").write_text("1,2,3,4\n5,6,7,8\n")
    (tmp_path / "a" / "b" / "mask.csv").write_text("0.1,0.9\n0.5,0.2\n")
    return tmp_path


def test_files_and_texts(spark, folder):
    keys = lambda *a: sorted(r["key"] for r in R.list_files(spark, str(folder), *a).collect())
    assert keys(".txt") == ["a/b/p2.txt", "a/p1.x.txt"] and keys(".txt", "", 1) == ["a/p1.x.txt"] and keys("", "b/", None) == ["a/b/box.csv", "a/b/mask.csv", "a/b/p2.txt"]
    lines = R.read_lines(spark, str(folder / "a" / "p1.x.txt")).orderBy("line_no").collect()
    assert [r["line"] for r in lines] == ["one\n", "two\n", "\n", "last"]
    assert "byte" in R.read_texts(spark, str(folder / "a" / "b" / "p2.txt")).first()["text"]
    img = R.read_images(spark, str(folder / "a" / "p1.x.txt")).first()
    assert (img["page_id"], img["length"]) == ("p1", 13)


def test_boxes_and_masks(spark, folder):
    b = R.read_boxes(spark, str(folder / "a" / "b" / "box.csv")).orderBy("seg_id").collect()
    assert [tuple(r) for r in b] == [("box", 0, 1, 2, 3, 4), ("box", 1, 5, 6, 7, 8)]
    m = R.read_mask(spark, str(folder / "a" / "b" / "mask.csv")).collect()
    assert {(r["row"], r["col"]): r["prob"] for r in m} == {(0, 0): 0.1, (0, 1): 0.9, (1, 0): 0.5, (1, 1): 0.2}


def test_ocr_and_words_round_trip(spark, tmp_path):
    block = lambda kind, text: {"BlockType": kind, "Text": text, "Confidence": 9.5, "Geometry": {"BoundingBox": {"Left": 0.1, "Top": 0.2, "Width": 0.3, "Height": 0.1}}}
    d = spark.createDataFrame([(1, json.dumps({"Blocks": [block("LINE", "a,b c"), block("WORD", "a,b"), block("WORD", "c")]}), 100, 200)], "page_id long, response string, crop_w int, crop_h int")
    words = R.ocr_words(d)
    assert [(r["word"], r["x_min"], r["y_min"], r["x_max"], r["y_max"]) for r in words.orderBy("word_seq").collect()] == [("a,b", 10, 40, 40, 60), ("c", 10, 40, 40, 60)]
    segs = spark.createDataFrame([(1, 0, 0, 0, 99, 199)], "page_id long, seg_id int, x_min int, y_min int, x_max int, y_max int")
    ordered = L.read_order(L.assign_segments(words.drop("segment").withColumn("segment", F.lit(0)), segs))
    assert L.word_lines(ordered).orderBy("read_pos").first()["line"] == "a,b,0,9.5,10,40,40,60"
    path = tmp_path / "p7.json"
    path.write_text(W.words_json(ordered).first()["json"])
    back = R.read_words(spark, str(path)).orderBy("word_seq").collect()
    assert [(r["page_id"], r["word"], r["read_order_segment_id"], r["y_max"]) for r in back] == [("p7", "a,b", 0, 60), ("p7", "c", 0, 60)]
    W.write_words(ordered, str(tmp_path / "lines"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "lines")).collect())[0].startswith("a,b,0")
    W.write_words(ordered, str(tmp_path / "csv"), quoted=True)
    assert spark.read.csv(str(tmp_path / "csv")).where("_c0 = 'a,b'").count() == 1


def test_layout_labels(spark):
    xml = '<p><particle classification="article"><s><subparticle rect="0,0,65535,32768"/></s><subparticle rect="1,1,2,2"/></particle><particle classification="ad"><subparticle rect="5,5,6,6"/></particle></p>'
    d = spark.createDataFrame([(1, xml, 1000, 2000)], "page_id long, xml string, page_w int, page_h int")
    assert [tuple(r) for r in R.layout_boxes(d).orderBy("seg_id").collect()] == [(1, 1, 0, 0, 0, 1000, 1000), (1, 1, 1, 0, 0, 0, 0)]


def test_crop_gate_is_strict(spark):
    small, large = R.crops_by_size(spark.createDataFrame([(10485759,), (10485760,), (None,)], "length long"))
    assert (small.count(), large.count()) == (1, 2)


def test_keys(spark):
    d = spark.createDataFrame([("a/1",), ("b/1",), ("c",)], "key string")
    assert [(r["key"], r["prefix_no"]) for r in R.crop_keys(d, ["b/", "a/"]).orderBy("key").collect()] == [("a/1", 1), ("b/1", 0)]
    truth = spark.createDataFrame([(2, "gt_9", "late"), (1, "g_9", "first")], "ordinal int, file string, text string")
    files = spark.createDataFrame([("x_9",), ("x_8",)], "file string")
    r = R.join_by_key(files, truth, F.element_at(F.split("file", "_"), -1), F.element_at(F.split("file", "_"), -1)).orderBy("file").collect()
    assert [(x["file"], x["truth"]) for x in r] == [("x_8", None), ("x_9", "first")]


def test_params(tmp_path):
    path = tmp_path / "p.json"
    path.write_text('{"rate": 0.1}')
    p = R.Params(str(path))
    p.dict["rate"] = 0.2
    p.save(str(path))
    assert R.Params(str(path)).rate == 0.2


def test_writers(spark, tmp_path):
    W.write_lines(spark.createDataFrame([(["a", "b"],)], "line array<string>"), str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first()["value"] == "a b"
    for s in (0.5, 0.25):
        W.append_scores(spark.createDataFrame([("f", s)], "file string, score double"), str(tmp_path / "s"), "file", "score")
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "s")).collect()) == ["f,0.25", "f,0.5"]
    b = spark.createDataFrame([(1, 0, 1, 2, 3, 4)], "page_id long, seg_id int, x_min int, y_min int, x_max int, y_max int")
    W.write_boxes(b, str(tmp_path / "b"), "raw")
    assert spark.read.schema(R.BOX).csv(str(tmp_path / "b" / "stage=raw" / "page_id=1")).first()["y_max"] == 4
    r = spark.createDataFrame([("x/p1.scan.png",)], "p string").select(*W.output_names(F.col("p"))).first()
    assert tuple(r) == ("x/p1.scan.txt", "x/p1.scan.json")


def test_streams_take_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda f, e, t: json.dumps({"file_name": f, "event": e, "ts": f"2024-01-01T00:00:0{t}Z"}) + "\n"
    (tmp_path / "in" / "1.json").write_text(row("a", "starttime", 1) + row("a", "endtime", 4) + row("b", "starttime", 2))
    go = lambda: S.run_once(S.stream_log(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    go()
    go()
    (tmp_path / "in" / "2.json").write_text(row("b", "errortime", 3))
    go()
    log = spark.read.schema(S.LOG).parquet(str(tmp_path / "out"))
    assert {r["file_name"]: (r["event"], r["n_events"]) for r in S.latest_status(log).collect()} == {"a": ("endtime", 2), "b": ("errortime", 2)}
    assert [r["file_name"] for r in S.failures(log).collect()] == ["b"]
    assert {r["file_name"]: r["seconds"] for r in S.durations(log).collect()} == {"a": 3.0, "b": None}
    assert S.load_multiplier(log, 5).count() == 20
