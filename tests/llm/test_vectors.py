import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm.near_vectors import near_duplicates, plan_tables
from pageloom.llm.permutation import nearest

ODD = [(900, None, 1), (901, [0.0] * 8, 1), (902, [1.0] * 7 + [None], 1), (903, [1.0] * 7 + [float("nan")], 1), (904, [1.0] * 7 + [float("inf")], 1), (905, [], 1), (906, [1.0, 2.0], 1), (907, [1.0, 2.0], 1)]


def data(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, 8))
    rows = []
    for i in range(600):
        v = base[0 if i % 3 == 0 else i % 40] + rng.standard_normal(8) * rng.choice([0, 0.02, 0.08, 0.3])
        rows.append((i, v.astype(np.float32).tolist(), None if i % 50 == 49 else i % 4))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links string, score int")


def test_links_and_components_against_brute_force(spark):
    rows = data() + [(i, data()[0][1], 0) for i in (700, 701, 3)] + ODD + [(None, data()[5][1], 1)]
    out = near_duplicates(frame(spark, rows), block=64).toPandas()
    assert len(out) == len(rows)
    good = [r for r in rows if r[1] and len(r[1]) == 8 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) and r[2] is not None]
    x = np.array([r[1] for r in good], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lab = np.array([r[2] for r in good])
    near = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(good))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(root)).min(axis=1))
        if (low == root).all():
            break
        root = low
    ids = np.array([np.nan if r[0] is None else r[0] for r in good], float)
    least = {k: np.nanmin(ids[root == k]) for k in set(root.tolist())}
    want = sorted((i if i == i else -1, int(n), least[k]) for i, n, k in zip(ids, near.sum(axis=1), root.tolist(), strict=True))
    known = {r[0] for r in good}
    got = sorted((r.vec_id if r.vec_id == r.vec_id else -1, r.n_links, r.component_id) for r in out.itertuples() if r.vec_id != r.vec_id or r.vec_id in known)
    assert got == want
    rest = out[out["vec_id"].isin([r[0] for r in ODD[:6]])]
    assert (rest["n_links"] == 0).all() and (rest["vec_id"] == rest["component_id"]).all()
    assert out[out["vec_id"] == 907]["component_id"].iloc[0] == 906  # equal vectors of another length link
    assert (out["kept"] == (out["vec_id"] == out["component_id"])).all()


def test_no_vectors(spark):
    assert near_duplicates(frame(spark, data()).where("false")).count() == 0
    assert near_duplicates(frame(spark, ODD[:3])).count() == 3
    assert nearest(frame(spark, data()).where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_tables_bound_the_miss():
    for rows in (10, 5000, 10**7):
        bits, tables = plan_tables(rows, 0.98)
        assert (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** tables <= 1e-5


def test_search_recall_and_order(spark):
    rows = data(2) + ODD + [(20, data(2)[20][1], 3)]
    out = nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=256, query_rows=16).toPandas()
    seen = {r[0]: np.array(r[1], np.float64) for r in data(2)}
    hit = total = 0
    for q in range(0, 600, 20):
        part = out[out["query_id"] == q].sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part["vec_id"])
        exact = sorted(((-float(v @ seen[q]), i) for i, v in seen.items() if i != q))[:20]
        hit += len(set(part["vec_id"]) & {i for _, i in exact})
        total += 20
        for r in part.itertuples():
            assert abs(r.score - float(seen[r.vec_id] @ seen[q])) < 1e-9
        keys = list(zip(-part["score"], part["vec_id"], strict=True))
        assert keys == sorted(keys)
    assert hit / total >= 0.9


def test_few_candidates_are_all_returned(spark):
    out = nearest(frame(spark, data()[:7]), F.col("vec_id") == 0).toPandas()
    assert sorted(out["vec_id"]) == [1, 2, 3, 4, 5, 6]


def test_queries_may_be_named_by_any_column(spark):
    d = frame(spark, data()[:40]).withColumns({"q": F.col("vec_id") == 3, "pivots": F.lit("x"), "s": F.lit(1), "rank": F.lit(2)})
    out = nearest(d, F.col("q"), k=5).toPandas()
    assert set(out["query_id"]) == {3} and out["rank"].tolist() == [1, 2, 3, 4, 5] and out.columns.tolist() == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, scale):
    d = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    out = nearest(d, F.col("vec_id") % 20 == 0).toPandas()
    e = d.toPandas()
    x, ids = np.stack(e["embedding"].to_numpy()).astype(float), e["vec_id"].to_numpy()
    hits = []
    for q, own in out.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(set(own["vec_id"]) & set(ids[np.lexsort((ids, -score))[:20]])) / 20)
    assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.95
