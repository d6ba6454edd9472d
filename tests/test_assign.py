import numpy as np
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES
from pageloom.operators import assign as A
from pageloom.operators import layout as L
from pageloom.plans import fixtures as X
from pageloom.plans import layout as P

SF = "/root/testdata/sf0.001"


def plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_pages_as_rows_are_the_words_and_segments(spark):
    rows = X.page_rows(spark, SF)
    words = rows.select("page_id", F.inline("words"))
    segs = rows.select("page_id", F.inline("segs"))
    names = ("page_id", "word_seq", "word", *SIDES)
    assert sorted(map(tuple, words.select(*names).collect())) == sorted(map(tuple, X.words(spark, SF).select(*names).collect()))
    names = ("page_id", "seg_id", *SIDES)
    assert sorted(map(tuple, segs.select(*names).collect())) == sorted(map(tuple, X.segments(spark, SF).select(*names).collect()))


def test_no_word_is_joined_sent_or_sorted_by_itself(spark):
    for query in (P.reordered_words, P.unassigned_count, P.assign_segment):
        text = plan(query(spark, SF))
        assert "Join" not in text and "Window" not in text and "Sort" not in text and text.count("Exchange") == 1


def slow(word, segs):
    inside, near = None, None
    area = (word[2] - word[0] + 1) * (word[3] - word[1] + 1)
    cx, cy = (word[0] + word[2]) / 2, (word[1] + word[3]) / 2
    for i, s in segs:
        w, h = max(0, min(word[2], s[2]) - max(word[0], s[0]) + 1), max(0, min(word[3], s[3]) - max(word[1], s[1]) + 1)
        if w * h / area > L.INSIDE:
            inside = i
        d = (((cx - s[0]) ** 2 + (cy - s[1]) ** 2) ** 0.5 + ((cx - s[2]) ** 2 + (cy - s[3]) ** 2) ** 0.5) / 2
        if d < 1e5 and (near is None or (d, i) < near):
            near = (d, i)
    return inside, inside if inside is not None else near and near[1]


def test_chunks_of_pages_of_all_sizes(spark, monkeypatch):
    rng = np.random.default_rng(5)

    def box(far=1):
        x, y = (int(v) * far for v in rng.integers(0, 400, 2))
        return (x, y, x + int(rng.integers(1, 120)), y + int(rng.integers(1, 120)))

    words, segs = [], []
    for page in range(60):
        segs += [(page, i * 3, *box()) for i in range(int(rng.integers(0, 7)))]
        words += [(page, i, f"w{i}", *box(1000 if i % 11 == 5 else 1)) for i in range(int(rng.integers(1, 40)))]
    words.append((None, 0, "nowhere", 0, 0, 5, 5))
    sides = ", ".join(f"{s} int" for s in SIDES)
    w = spark.createDataFrame(words, f"page_id long, word_seq long, word string, {sides}")
    s = spark.createDataFrame(segs, f"page_id long, seg_id int, {sides}")
    got = {(r["page_id"], r["word_seq"]): (r["inside_segment_id"], r["read_order_segment_id"]) for r in L.assign_segments(w, s).collect()}
    of = lambda page: [(r[1], r[2:]) for r in segs if r[0] == page]
    want = {(r[0], r[1]): slow(r[3:], of(r[0])) for r in words}
    assert got == want and len(got) == len(words)

    # The same in reading order, a few words at a time.
    lists = lambda d: F.collect_list(F.struct(*[c for c in d.columns if c != "page_id"]))
    pages = w.where("page_id IS NOT NULL").groupBy("page_id").agg(lists(w).alias("words")).join(s.groupBy("page_id").agg(F.array_sort(lists(s)).alias("segs")), "page_id", "left")
    batches = pages.select("page_id", "words", "segs").toArrow().combine_chunks().to_batches()
    monkeypatch.setattr(A, "_AT_ONCE", 50)
    out = [r for b in A._worker(L.INSIDE, L.SEARCH_RADIUS, True)(iter(batches)) for r in b.to_pylist()]
    assert {r["page_id"] for r in out} == set(range(60))
    for r in out:
        keys = [(want[r["page_id"], x["word_seq"]][1], x["word_seq"]) for x in r["words"]]
        assert keys == sorted(keys, key=lambda k: (k[0] is None, k[0] or 0, k[1]))
        assert all((x["inside_segment_id"], x["read_order_segment_id"]) == want[r["page_id"], x["word_seq"]] for x in r["words"])
