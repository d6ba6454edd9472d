import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pageloom.functions.geometry import SIDES, from_corners
from pageloom.operators import cleanup as C
from pageloom.operators.graph import connected_components
from test_layout import boxes


def some(seed, pages=40, aside=60):
    rnd, rows = random.Random(seed), []
    for page in range(pages):
        for i in range(rnd.randint(1, 30)):
            x, y = rnd.choice([0, 20, 400, 900]) + rnd.randint(0, aside), rnd.randint(0, 40) * 50
            rows.append((page, i * 2, (x, y, x + rnd.choice([250, 350, 400]), y + rnd.randint(0, 600))))
    return rows


def by_relations(b, radius=70):
    """Clusters by edges and connected components of all pages together."""
    number = lambda p, s, c: F.struct(F.col(p).alias("p"), F.col(s).alias("s"), F.col(c).alias("c"))
    edges = C.vertex_edges(b, radius).select(number("page_id", "i", "ci").alias("src"), number("page_id", "j", "cj").alias("dst"))
    corners = C.corner_rows(b).withColumn("id", number("page_id", "seg_id", "corner")).join(connected_components(edges), "id", "left")
    means = corners.where("component IS NOT NULL").groupBy("component").agg(F.avg("x").cast("int").alias("mx"), F.avg("y").cast("int").alias("my"))
    moved = corners.join(means, "component", "left").select("page_id", "seg_id", "corner", F.struct(F.coalesce("mx", "x").alias("x"), F.coalesce("my", "y").alias("y")).alias("p"))
    back = moved.groupBy("page_id", "seg_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("corner", "p"))), lambda v: v["p"]).alias("c"))
    return back.select("page_id", "seg_id", *from_corners(F.col("c")).named())


def plain(d, *more):
    return sorted(tuple(r[c] for c in ("page_id", *more, *SIDES)) for r in d.collect())


def test_clusters_are_the_components_and_cost_one_shuffle(spark):
    b = boxes(spark, some(1)).cache()
    assert plain(C.cluster_vertices(b), "seg_id") == plain(by_relations(b), "seg_id")
    text = C.cluster_vertices(b)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hash") == 1 and "Join" not in text


def test_page_steps_are_the_relational_ones(spark):
    rows = some(2, aside=0)
    b = boxes(spark, rows).cache()
    pages = {p: (np.array([i for q, i, _ in rows if q == p]), np.array([s for q, _, s in rows if q == p])) for p in range(40)}
    gone = {p: set(i[C.overlapped(s)].tolist()) for p, (i, s) in pages.items()}
    kept = {(r["page_id"], r["seg_id"]) for r in C.remove_overlaps(b).collect()}
    assert kept == {(p, i) for p, i, _ in rows if i not in gone[p]} and any(gone.values())
    merged = plain(C.vertical_merge(b))
    assert merged == sorted((p, *r) for p, (_, s) in pages.items() for r in C.vertical_merge_page(s).tolist()) and len(merged) < len(rows)
    want = {r["page_id"]: (r["thresh"], r["wide_part"]) for r in C.read_order_thresholds(b, 4000).collect()}
    assert {p: C.page_thresholds(s, 4000) for p, (_, s) in pages.items()} == want


def test_post_process_is_its_steps_in_one_shuffle(spark):
    b = boxes(spark, some(3)).cache()
    columns = ["page_id", "seg_id", *SIDES]

    def split(d, n):
        counted = d.withColumn("_n", F.count("*").over(Window.partitionBy("page_id")))
        return counted.where(F.col("_n") > n).drop("_n"), counted.where(F.col("_n") <= n).drop("_n")

    many, few = split(C.remove_overlaps(b), 6)
    d = C.merge_small_boxes(C.align_read_order(many, 4000)).select(*columns).unionByName(few.select(*columns)).cache()
    many, few = split(by_relations(d).cache(), 16)
    merged = C.vertical_merge(C.align_read_order(many, 5000, 250, 0.3)).drop("merged")
    w = Window.partitionBy("page_id").orderBy(*SIDES)
    merged = merged.withColumn("seg_id", (F.row_number().over(w) - 1).cast("int"))
    want = C.clamp_and_validate(merged.select(*columns).unionByName(few.select(*columns)), 4000, 2500)
    assert plain(C.post_process(b, 4000, 2500), "seg_id") == plain(want, "seg_id")
    text = C.post_process(b, 4000, 2500)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hash") == 1 and "Join" not in text and "Window" not in text
