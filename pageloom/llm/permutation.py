"""Nearest neighbours by a permutation index over pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.vectors import matrix, usable
from pageloom.session import materialize, table


#: A vector whose order agrees with the query's to this part of a perfect agreement is always scored.
ALIKE = 0.7


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with one more component that gives all the same length: largest inner product becomes smallest angle."""
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _order(pivots: np.ndarray, nearest: int, norm: float):  # noqa: ANN202
    """Adds a vector's nearest pivots in order: ``pivots`` of the lifted vector, ``asked`` of the vector as a query."""
    lifted = _lifted(pivots, norm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("embedding"))
                out = []
                for near in (_lifted(x, norm) @ lifted.T, x @ pivots.T):
                    order = np.argsort(-near, axis=1, kind="stable")[:, :nearest].astype(np.int16)
                    offsets = pa.array(np.arange(0, order.size + 1, order.shape[1], dtype=np.int32))
                    out.append(pa.ListArray.from_arrays(offsets, pa.array(order.ravel())))
                yield pa.record_batch([b.column("vec_id"), b.column("embedding"), b.column("q"), *out], names=["vec_id", "embedding", "q", "pivots", "asked"])

    return run


def spread(sample: np.ndarray, most: int, alike: float = 0.8) -> np.ndarray:
    """The first ``most`` of the sample that are no near copies (cosine over ``alike``) of one before."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    kept: list[int] = []
    for k in range(len(sample)):
        if not kept or (unit[kept] @ unit[k]).max() <= alike:
            kept.append(k)
        if len(kept) == most:
            break
    return sample[kept]


def _search(n_pivots: int, k: int, share: float, least: int):  # noqa: ANN202
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        x = np.stack(vectors["embedding"].to_numpy()).astype(np.float64)
        ids = vectors["vec_id"].to_numpy(np.int64)
        perms = np.stack(vectors["pivots"].to_numpy()).astype(np.int64)
        n, depth = perms.shape
        # The inverted files: for each pivot the vectors that have it among their nearest, with depth less the place where it stands.
        by_pivot = np.argsort(perms.ravel(), kind="stable")
        posted, worth = (by_pivot // depth).astype(np.int32), (depth - by_pivot % depth).astype(np.int32)
        cuts = np.searchsorted(perms.ravel()[by_pivot], np.arange(n_pivots + 1))
        want = min(n, max(least, int(np.ceil(share * n))))
        alike = ALIKE * depth * (depth + 1) / 2
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for qid, q, perm in zip(queries["vec_id"].to_numpy(np.int64), queries["embedding"], queries["asked"], strict=True):
            lists = [slice(cuts[p], cuts[p + 1]) for p in perm.tolist()]
            met = np.concatenate([posted[x] for x in lists])
            # Footrule distance over the posted places, other pivots at place depth + 1: a constant less twice this sum.
            shared = np.concatenate([np.minimum(worth[x], depth - at) for at, x in enumerate(lists)])
            gain = np.bincount(met, weights=shared, minlength=n)
            near = np.flatnonzero(gain)
            near = near[ids[near] != qid]
            if len(near) > want:
                g = gain[near]
                near = near[g >= min(np.partition(g, len(g) - want)[len(g) - want], alike)]
            elif len(near) < min(k, n - 1):  # too few share a pivot: a shard without kin of the query
                near = np.flatnonzero(ids != qid)
            score = x[near] @ np.asarray(q, np.float64)
            best = np.lexsort((ids[near], -score))[:k]
            out.append((np.full(len(best), qid), ids[near][best], score[best]))
        q, v, s = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, n_pivots: int = 512, depth: int = 64, share: float = 0.15, least: int = 400,
    shard_rows: int = 2048, query_rows: int = 4096, seed: int = 3,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each query row.

    Pivots are at most ``n_pivots`` vectors out of the first 8 * n_pivots by a
    seeded hash of the id, near copies left out: a bounded sample that only
    fits the index. Every vector is represented
    by its ``depth`` nearest pivots in order and lies in one shard. A task
    takes a shard and a block of queries and posts the shard in pivot inverted
    files, each vector under its nearest pivots alone. A query reads the files of its own
    nearest pivots; what it meets there is ranked by footrule distance, and the nearest
    ``share`` of the shard (``least`` at least) are scored exactly, in double precision,
    and with them all whose order is nearly the query's, so that a group of
    near copies is scored whole whatever its size. Indexed vectors are lifted
    to one length first, so that order by angle is order by inner product.
    The queries are a stated set, met with all rows in blocks: (shards x query
    blocks) tasks of bounded size. Measured recall is in the tests.

    Vectors that are null, empty, zero, non-finite or of another length than
    most, or have a null id, take no part. Rows of one vec_id count once (the
    smallest vector). Ties go to the smaller vec_id. No rows: no rows. Columns other than vec_id, embedding
    and those that ``is_query`` names are ignored, whatever their names.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), is_query.alias("q"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    v = v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.coalesce(F.max("q"), F.lit(False)).alias("q"))
    shape = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    spark = vectors.sparkSession
    if not shape:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = v.where(F.size("embedding") == shape["d"])
    sample = v.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(8 * n_pivots).select("embedding").toPandas()
    pivots = spread(np.stack(sample["embedding"].to_numpy()).astype(np.float64), n_pivots)
    depth = min(depth, len(pivots))
    norm = v.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, c: s + c.cast("double") * c))).first()[0] ** 0.5
    fields = "vec_id long, embedding array<float>, q boolean, pivots array<smallint>, asked array<smallint>"
    index = materialize(v.mapInArrow(_order(pivots, depth, norm), fields), "permutations")
    n = shape["n"]
    shard_rows = max(shard_rows, min(65536, -(-n // 8)))
    asked = index.where("q")
    shards, blocks = -(-n // shard_rows), max(1, -(-asked.count() // query_rows))
    left = index.drop("asked", "q").withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.drop("pivots", "q").withColumn("b", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInPandas(_search(len(pivots), k, share, least), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
