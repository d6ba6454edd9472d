"""Embedding near-dedup: sign hashing in several tables, exact cosine, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.vectors import matrix, usable
from pageloom.operators.graph import connected_components
from pageloom.session import materialize, table

#: Rows of a bucket that are compared as one block.
BLOCK = 512


def plan_tables(rows: int, threshold: float, miss: float = 1e-5) -> tuple[int, int]:
    """(bits, tables): about one unrelated vector per bucket, and a pair at the threshold missed with probability ``miss``."""
    bits = max(8, min(24, math.ceil(math.log2(max(rows, 2))) + 1))
    same = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-min(same, 1 - 1e-12)))


def _sign(bits: int, tables: int, seed: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))
                side = (matrix(part.column("embedding")) @ planes[dim] >= 0).reshape(part.num_rows, tables, bits)
                codes = side @ (1 << np.arange(bits, dtype=np.int64))
                sigs = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32)), pa.array(codes.ravel().astype(np.int32)))
                yield pa.record_batch([*[part.column(c) for c in ("rid", "label", "dim", "copies", "least")], sigs, part.column("embedding")], names=["rid", "label", "dim", "copies", "least", "sigs", "embedding"])

    return run


def _compare(threshold: float):  # noqa: ANN202
    def block(t: int, left: np.ndarray, x: np.ndarray, sigs: np.ndarray, copies: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows linked, links first met in table t, smallest linked row of the block's component)."""
        cos = np.clip(x @ x.T, -1, 1)
        near = cos >= threshold
        for i, j in np.argwhere(np.abs(cos - threshold) < 1e-9):
            near[i, j] = float(np.dot(x[i], x[j])) >= threshold
        np.fill_diagonal(near, False)
        if not left.all():
            near &= left[:, None] != left[None, :]
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            return rows, rows, rows
        near = near[np.ix_(rows, rows)]
        root = np.arange(len(rows))
        while True:
            low = np.minimum(root, np.where(near, root[None, :], len(rows)).min(axis=1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        s = sigs[rows]
        for u in range(t):
            near &= s[:, None, u] != s[None, :, u]
        return rows, near @ copies[rows], rid[rows][root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(rows: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            keys = np.stack([rows.column(c).to_numpy() for c in ("t", "label", "dim", "sig", "bi", "bj")], axis=1)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *cut.tolist(), len(keys)]
            stop = len(bounds) - 1 if final else len(bounds) - 2
            held = None if final else rows.slice(bounds[stop])
            if stop <= 0:
                return
            rid, copies, left = (rows.column(c).to_numpy() for c in ("rid", "copies", "left"))
            sigs = matrix(rows.column("sigs")).astype(np.int64)
            out: list[list[np.ndarray]] = [[], [], []]
            dims = keys[:, 2]
            for dim in np.unique(dims[: bounds[stop]]).tolist():
                at = np.flatnonzero(dims == dim)
                x = matrix(rows.column("embedding").take(pa.array(at)))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                place = np.zeros(len(dims), np.int64)
                place[at] = np.arange(len(at))
                for k in range(stop):
                    lo, hi = bounds[k], bounds[k + 1]
                    if hi - lo > 1 and dims[lo] == dim:
                        y = x[place[lo] : place[lo] + hi - lo]
                        if hi - lo == 2 and float(y[0] @ y[1]) < threshold - 1e-9:
                            continue
                        r, links, root = block(int(keys[lo, 0]), left[lo:hi], y, sigs[lo:hi], copies[lo:hi], rid[lo:hi])
                        if len(r):
                            for o, v in zip(out, (rid[lo:hi][r], links, root), strict=True):
                                o.append(v)
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(o).astype(np.int64)) for o in out], names=["rid", "links", "root"])

        for b in batches:
            t = pa.Table.from_batches([b])
            yield from groups(t if held is None else pa.concat_tables([held, t]), False)
        if held is not None and held.num_rows:
            yield from groups(held, True)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors(vec_id, embedding, label).

    Equal vectors of a label are one class and are compared once. Each class
    gets a sign code per table; buckets of a single class are dropped before
    vectors move. A larger bucket is cut into blocks of ``block`` classes, a
    task compares two blocks by one matrix product in double precision, and
    what leaves it is one row per linked class: a count of links not met in an
    earlier table, and a root that spans the block's links. So a pair counts
    once and no bucket's pairs are ever listed. Components are contracted
    across the cluster.

    A row without label, or with a null, empty, zero or non-finite vector, or
    of another length than others, links with nothing like it is not: such a
    row is its own component. Repeated rows link with each other. Null vec_id
    takes part and is never kept. An empty table gives no rows.
    """
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<float>").alias("embedding"))
    v = v.withColumn("ok", F.col("label").isNotNull() & usable(F.col("embedding"))).withColumn("h", F.xxhash64("embedding"))
    classes = v.where("ok").groupBy("label", "h", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = classes.withColumn("rid", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding"))
    most = v.where("ok").groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = plan_tables(most, threshold)
    signed = materialize(
        classes.select("rid", F.col("label").cast("long").alias("label"), "dim", "copies", "least", "embedding").mapInArrow(
            _sign(bits, tables, seed), "rid long, label long, dim int, copies long, least long, sigs array<int>, embedding array<float>"
        ),
        "near-vectors",
    )
    key = ["t", "label", "dim", "sig"]
    posted = signed.select("rid", "label", "dim", F.posexplode("sigs").alias("t", "sig"))
    full = posted.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1")
    posted = posted.join(full, key).withColumn("nb", F.ceil(F.col("m") / block).cast("int"))
    posted = posted.withColumn("b", F.pmod(F.xxhash64("rid"), F.col("nb")).cast("int"))
    posted = posted.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    posted = posted.select("rid", "t", "sig", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), (F.col("b") <= F.col("o")).alias("left"), (F.col("b") == F.col("o")).alias("same"))
    met = posted.join(signed, "rid")
    order = [*key, "bi", "bj"]
    met = met.select(*[F.col(c).cast("long").alias(c) for c in order], "rid", "copies", "left", "sigs", "embedding").repartition(*order).sortWithinPartitions(*order)
    found = materialize(met.mapInArrow(_compare(threshold), "rid long, links long, root long"), "near-links")
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    comp = connected_components(found, "rid", "root").withColumnRenamed("id", "rid")
    per_class = signed.select("rid", "least", "copies").join(links, "rid", "left").join(comp, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    least = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = per_class.join(least, "component").select("rid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    named = signed.select("rid", F.col("label"), F.xxhash64("embedding").alias("h"), "embedding").join(per_class, "rid").drop("rid")
    ok = v.where("ok").withColumn("label", F.col("label").cast("long")).join(named, ["label", "h", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = v.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ok.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs of one label: for small tables only.
OP10_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
), u AS MATERIALIZED (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM v),
pairs AS MATERIALIZED (SELECT a.vec_id AS i, b.vec_id AS j FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
sym AS MATERIALIZED (SELECT i AS a, j AS b FROM pairs UNION ALL SELECT j, i FROM pairs),
reach AS (SELECT a, b FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON s.a = r.b),
comp AS (SELECT a AS vec_id, least(a, min(b)) AS component_id FROM reach GROUP BY a),
links AS (SELECT a AS vec_id, count(*) AS n_links FROM sym GROUP BY a)
SELECT d.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, d.vec_id) AS component_id, coalesce(component_id, d.vec_id) = d.vec_id AS kept
FROM embeddings d LEFT JOIN comp USING (vec_id) LEFT JOIN links USING (vec_id)
"""
