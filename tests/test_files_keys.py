"""Page keys that are file names, files with a result each, and the texts' distances against plain code."""

import random

import numpy as np
from pyspark.sql import functions as F

from pageloom.functions.geometry import distance_n
from pageloom.functions.text import match_ratio, word_distance
from pageloom.operators import cleanup as C
from pageloom.operators import evaluate as E
from pageloom.operators import lifecycle as Y
from pageloom.operators import mask as K
from pageloom.operators import metrics as M
from pageloom.session import work_path
from pageloom.sources import readers as R
from pageloom.sources import writers as W
from pageloom.streaming import tasks as S


def test_pages_named_by_files_go_through_the_lifecycle(spark):
    grid = np.zeros((20, 20))
    grid[2:8, 1:9] = grid[2:9, 11:19] = grid[12:18, 1:9] = 0.9
    content = "\n".join(",".join(map(str, line)) for line in grid)
    base = work_path(spark, "named")
    done = W.write_files(spark.createDataFrame([("page-001.csv", content), ("page-002.csv", content)], "name string, content string"), base)
    assert [r["ok"] for r in done.collect()] == [True, True]
    m = R.read_mask(spark, f"{base}/*.csv")
    pages = spark.createDataFrame([("page-001", 200, 400), ("page-002", 200, 400)], "page_id string, page_w int, page_h int")
    stages = Y.ordered_segments(m, pages, least_area=10, grid=20)
    assert stages["raw"].where("page_id = 'page-001'").count() == 3
    assert {r["page_id"] for r in stages["combined"].collect()} == {"page-001", "page-002"}
    boxes = stages["bbox"]
    whole = K.morphology(m.select("page_id", "row", "col", (F.col("prob") > 0.5).cast("int").alias("value")), [("open", "square", 1)])
    assert whole.where("page_id = 'page-002' AND value = 1").count() == int((grid > 0).sum())
    for d in (C.align_read_order(boxes, 200, 50, 0.9), C.merge_small_boxes(boxes, 10, 5), C.cluster_vertices(boxes), C.post_process(boxes, 200, 400)):
        assert {r["page_id"] for r in d.collect()} == {"page-001", "page-002"}


def test_a_file_that_fails_is_a_row(spark):
    base = work_path(spark, "fails")
    rows = [("a.txt", "one"), ("a.txt/b.txt", "two"), ("c/d.txt", "x")]
    done = {r["name"]: (r["ok"], r["error"]) for r in W.write_files(spark.createDataFrame(rows, "name string, content string").coalesce(1), base).collect()}
    assert done["a.txt"] == (True, None) and done["c/d.txt"] == (True, None) and done["a.txt/b.txt"][0] is False and done["a.txt/b.txt"][1]
    assert {r["key"] for r in R.list_files(spark, base).collect()} == {"a.txt", "c/d.txt"}


def test_words_as_csv_keep_their_order(spark):
    base = work_path(spark, "words-csv")
    words = [(p, f"w{9 - k}", k, 0, 99, k, 0, k + 1, 1) for p in (1, 2) for k in random.Random(p).sample(range(10), 10)]
    d = spark.createDataFrame(words, "page_id long, word string, read_pos int, read_order_segment_id int, confidence int, x_min int, y_min int, x_max int, y_max int")
    W.write_words(d, base, quoted=True)
    assert [r[0] for r in spark.read.csv(f"{base}/page_id=2").coalesce(1).collect()] == [f"w{9 - k}" for k in range(10)]


def test_kernels_of_struts():
    assert K.kernel_of_struts(1, 2).tolist() == np.ones((3, 5), int).tolist()
    assert K.kernel_of_struts(1, 1, "cross").tolist() == K.KERNELS["cross"] and K.kernel_of_struts(0, 1).tolist() == [[1, 1, 1]]
    assert K.kernel_of_struts(2, 2, "diamond").sum() == 13
    g = np.zeros((7, 7), int)
    g[1:6, 1:6] = 1
    assert (K.morph(g, K.kernel_of_struts(1, 1), "ed") == g).all() and K.morph(g, K.kernel_of_struts(0, 3), "e").sum() == 0


def ratio(x, y):
    """Fewest edits, then most matches, cell by cell."""
    row = [(j, 0) for j in range(len(y) + 1)]
    for i, c in enumerate(x, 1):
        new = [(i, 0)]
        for j, d in enumerate(y, 1):
            e, m = row[j - 1]
            new.append(min((e, m - 1) if c == d else (e + 1, m), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return 1.0 if not x and not y else 2.0 * -row[-1][1] / (len(x) + len(y))


def test_match_ratio_and_word_distance(spark):
    rnd = random.Random(5)
    pairs = [("".join(rnd.choices("abcé ", k=rnd.randint(0, 30))), "".join(rnd.choices("abcé ", k=rnd.randint(0, 30)))) for _ in range(80)] + [("", ""), ("a", ""), ("", "ab")]
    d = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    for r in d.select("a", "b", match_ratio("a", "b").alias("r")).collect():
        assert abs(r["r"] - ratio(r["a"], r["b"])) < 1e-9, (r["a"], r["b"])
    many = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(24_000)), lambda i: i.cast("string")).alias("a"), F.transform(F.sequence(F.lit(12_001), F.lit(36_400)), lambda i: i.cast("string")).alias("b"))
    short = many.select(F.slice("a", 23_990, 11).alias("a"), F.slice("b", 1, 10).alias("b"))
    assert short.select(word_distance(F.col("a"), F.col("b"))).first()[0] == 11
    wide = spark.range(1).select(F.sequence(F.lit(1), F.lit(36_400)).alias("s")).select(F.transform("s", lambda i: i.cast("string")).alias("a"), F.array(F.lit("36400")).alias("b"))
    assert wide.select(word_distance(F.col("a"), F.col("b"))).first()[0] == 36_399


def test_reports_over_logs_and_texts(spark):
    log = spark.createDataFrame([("a", "starttime", 0), ("a", "endtime", 30), ("b", "starttime", 10)], "file_name string, event string, s long").select("file_name", "event", F.timestamp_seconds("s").alias("ts"))
    assert tuple(S.time_totals(log).first()) == (2, 1, 30.0)
    assert tuple(S.progress(log, 4).first()) == (1, 4, 25.0, 30.0)
    texts = spark.createDataFrame([("a b", "x"), ("", "y z w")], "p string, q string")
    assert {r["column"]: (r["n_texts"], r["n_words"], r["least"], r["most"]) for r in M.word_length_report(texts, ["p", "q"]).collect()} == {"p": (2, 2, 0, 2), "q": (2, 4, 1, 3)}
    files = spark.createDataFrame([("in/scan_1.txt", "abcd"), ("in/scan_2.txt", "x")], "file string, text string")
    truth = spark.createDataFrame([("gt/t_1.txt", "abxd", 0)], "file string, text string, ordinal int")
    got = {r["file"]: (r["truth_file"], r["error"]) for r in E.suffix_errors(files, truth).collect()}
    assert got == {"in/scan_1.txt": ("gt/t_1.txt", 0.25), "in/scan_2.txt": (None, None)}
    d = spark.createDataFrame([([0.0, 0.0, 0.0], [1.0, 2.0, 2.0]), ([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert [r[0] for r in d.select(distance_n(F.col("a"), F.col("b"))).collect()] == [3.0, None]
