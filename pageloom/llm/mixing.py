"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.session import materialize, table

WORD = r"[^\x20\x09-\x0D]+"
#: How far from the greedy filling the dynamic programme looks, in words over their common divisor: first, and at most.
WINDOW, WIDEST = 1 << 15, 1 << 24
#: Hash cells that share the documents of one (source, length).
CELLS = 256


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, cap: float) -> DataFrame:
    """Adds weight and target to (skey, source, source_size), one row per source.

    Water filling: target = min(cap * size, level * weight), where the level
    makes the targets add up to budget * all sizes. That is the fixed point of
    stopping sources at their cap and resharing the excess by weight. The
    table has one row per source, so its unpartitioned windows stay small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = sizes.withColumn("pos", F.row_number().over(by_name))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("pos") - 1) % len(weights) + 1))
    s = s.withColumn("ceiling", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("ratio", F.col("ceiling") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "pos")
    s = s.withColumn("at", F.row_number().over(by_ratio))
    s = s.withColumn("total", F.sum("source_size").over(every))
    full = F.coalesce(F.sum("ceiling").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("total") * F.lit(float(budget)) - full) / open_)
    s = s.withColumn("first_open", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("at", "level"))).over(every))
    target = F.when(F.col("first_open").isNull() | (F.col("at") < F.col("first_open.at")), F.col("ceiling"))
    return s.select("skey", "source_size", target.otherwise(F.col("first_open.level") * F.col("weight")).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take: their words come to the largest sum reachable up to ``budget``.

    First every length gets its share, with the rounding error carried from
    the longest to the shortest length. From there a bounded-knapsack programme
    moves: it takes more of a length, as many as are left, or gives back, as
    many as are taken, and notes which differences from the greedy sum can be
    made. No sum is a better one than the budget without its remainder by the lengths'
    common divisor; when that is met, the programme ends. If it is not, the
    programme starts over with eight times the room for differences, up to
    what all moves together come to, or to (3 L + 1) L for a longest length L: if
    any selection meets a sum, one does that differs by no more moves than
    that (among more moves, ordered to stay near the budget, two sums would be equal,
    and those between could be left out). Only where that is more than
    WIDEST words can a sum remain that was not found.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    real = np.asarray(lengths) > 0
    total = int((lengths * counts)[real].sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return np.where(real, counts, 0)
    unit = int(np.gcd.reduce(np.asarray(lengths)[real]))
    size, budget, total = np.where(real, lengths, 0) // unit, budget // unit, total // unit
    order = [i for i in np.argsort(-size, kind="stable").tolist() if size[i] > 0]
    seen = taken = 0
    for i in order:
        seen += int(size[i]) * int(counts[i])
        take[i] = min(int(counts[i]), max(0, (budget * seen // total - taken) // int(size[i])))
        taken += int(size[i]) * int(take[i])
    left = budget - taken
    longest = int(size.max())
    bound = min(max(taken, total - taken), (3 * longest + 1) * longest + left)
    room = min(max(WINDOW, 2 * longest + left), bound)
    while True:
        moves = _moves(size, counts, take, order, left, room)
        if moves is not None or room >= min(bound, WIDEST):
            break
        room = min(8 * room, bound, WIDEST)
    if moves is None:
        moves = _moves(size, counts, take, order, left, room, nearest=True)
    for i, k in moves:
        take[i] += k
    return take


def _moves(size: np.ndarray, counts: np.ndarray, take: np.ndarray, order: list[int], left: int, room: int, nearest: bool = False) -> list[tuple[int, int]] | None:
    """(length, documents more or fewer) that add ``left`` words, by way of sums within ``room`` of 0; with ``nearest``, the most words up to ``left``."""
    reach = np.zeros(2 * room + 1, dtype=bool)  # place of a sum: room + sum
    goal = room + left
    if left > room:
        goal = 2 * room
    reach[room] = True
    parent = np.full(len(reach), -1, dtype=np.int32)
    items: list[tuple[int, int]] = []
    rest = {(i, sign): min(n, 2 * room // int(size[i])) for i in order for sign, n in ((1, int(counts[i] - take[i])), (-1, int(take[i])))}
    k = 1
    # Single documents of every length first, then twos, fours: what one length gives another takes back at once.
    while rest and not reach[goal]:
        for (i, sign), n in list(rest.items()):
            part = min(k, n)
            step = part * int(size[i])
            if part == n or step >= len(reach):
                del rest[i, sign]
            else:
                rest[i, sign] = n - part
            if not part or step >= len(reach):
                continue
            here, there = (reach[:-step], slice(step, None)) if sign > 0 else (reach[step:], slice(None, -step))
            new = here & ~reach[there]
            parent[there][new] = len(items)
            reach[there] |= new
            items.append((i, sign * part))
            if reach[goal]:
                break
        k *= 2
    if not reach[goal] and not nearest:
        return None
    at = int(np.flatnonzero(reach[: goal + 1])[-1])
    made = []
    while at != room:
        i, k = items[parent[at]]
        made.append((i, k))
        at -= k * int(size[i])
    return made


def _allocate(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size", kind="stable")
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    total, goal = int((lengths * counts).sum()), int(round(float(pdf["target"].iloc[0])))
    whole = goal // total if total else 0
    take = fit(lengths, counts, goal - whole * total) if total else np.zeros(len(pdf), np.int64)
    return pdf[["skey", "size", "source_size", "target"]].assign(whole=whole, take=take)


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """docs plus size, source_size, target, copies (0, 1, .. ceil(cap)).

    Documents are counted by exact word length per source. Whole passes over a
    source come first; the remaining budget is fitted by ``fit`` over the
    (length, count) table, never over documents. Which documents of a length
    are taken is decided by a seeded hash of id and text: hash cells split
    each (source, length), whole cells are taken by their counts (written
    once, so texts are read twice in all), and only rows within a cell are
    ranked. So no task holds a hot source or length,
    and reruns agree.

    Null text has size 0 and, as an empty one, costs nothing: it gets only the
    whole passes. A text of any length is one item of its size. Null source is a source, last in order. Equal rows are
    separate documents and interchangeable. An empty table gives no rows.
    Columns of docs that are named as one of the added are replaced; all others are kept, whatever their names.
    """
    added = ("size", "source_size", "target", "copies")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    # The caller's row is one column, so that its names cannot meet those used here.
    d = docs.select(
        F.struct(*kept).alias("doc"), "source", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("skey"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("h"),
    )
    d = d.withColumn("cell", F.pmod(F.col("h"), F.lit(CELLS)))
    cells = materialize(d.groupBy("skey", "size", "cell").agg(F.count("*").alias("n"), F.first("source").alias("source")), "mixing-cells")
    hist = cells.groupBy("skey", "size").agg(F.sum("n").alias("n"), F.first("source").alias("source"))
    per_source = hist.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.first("source").alias("source"))
    plan = hist.select("skey", "size", "n").join(targets(per_source, weights, budget, cap), "skey")
    plan = plan.groupBy("skey").applyInPandas(_allocate, "skey string, size long, source_size long, target double, whole long, take long")
    before = Window.partitionBy("skey", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("skey", "size", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # These tables grow with the documents, however small their files are: never broadcast.
    plan = plan.hint("merge").join(cells, ["skey", "size"])
    rank = F.row_number().over(Window.partitionBy("skey", "size", "cell").orderBy("h", "doc.doc_id"))
    d = d.drop("source").withColumn("rank", rank).join(plan.hint("merge"), ["skey", "size", "cell"])
    copies = (F.col("whole") + (F.col("before") + F.col("rank") <= F.col("take")).cast("long")).cast("int")
    return d.select("doc.*", "size", "source_size", "target", copies.alias("copies"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
