"""Mixture-controlled packing by deficit round-robin over source queues."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.tokens import ids_to_crc32, tokenize, tokenizer_path
from pageloom.session import materialize, table

END_ID = 1
#: Bytes of an id in the work table and in ``ids``; enough for vocabularies up to 65536.
WIDTH = 2
BLOCKS = 4096


def pack(docs: DataFrame, path: str | None = None, window: int = 2048, packet: int = 256, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset, source: one row per piece.

    Each source is a queue of packets of at most ``packet`` ids of one
    document. In round r of the round-robin a source's deficit grows by its
    quantum, window * share, and it sends packets while the deficit lasts.
    While a queue has packets the deficit after r rounds is r * quantum less
    what was sent, so a packet whose last id is the c-th of its queue leaves
    in round ceil(c / quantum). This closed form carries deficits across
    windows and partitions without a sequential pass: a queue's prefix sums
    give c, then prefix sums over rounds give each packet's place in the one
    stream, which is cut every ``window`` ids. Every window so holds the
    shares within a packet per source, none is padded but the last.

    Shares: ``weights`` by source, or (None) the sources' own token counts,
    so that all queues end together. Unlisted sources weigh 1. An emptied
    queue leaves its part of a round to the others.

    ids holds WIDTH bytes an id, little-endian. Null text is empty (one id), null source is a source of its own. Repeated
    rows are separate documents. Documents are read once and never shuffled
    whole until pieces meet ids by (part, seq); rounds, not sources, deal out
    the sort, so a hot source is no hot task. A text of any length is packets in a row. Packets
    due in one round go by source, then by place. An empty table gives no rows. Columns other than
    doc_id, text and source are ignored, whatever their names.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    made = materialize(tokenize(docs, path or tokenizer_path("byte_bpe_50k.json"), END_ID, key, WIDTH), "packing-ids")
    sums = made.groupBy("grp", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy("grp")
    sums = sums.select("grp", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(all_).alias("queue"))
    total = made.agg(F.sum("n")).first()[0] or 0
    if weights is None:
        quantum = F.col("queue") * F.lit(window / max(total, 1))
    else:
        named = {"-" if k is None else f"={k}": float(v) for k, v in weights.items()}
        whole = sum(named.values()) or 1.0
        share = F.coalesce(*[F.when(F.col("grp") == k, F.lit(v)) for k, v in named.items()], F.lit(1.0))
        quantum = share * F.lit(window / whole)
    sums = sums.withColumn("quantum", quantum)
    rounds = sums.agg(F.max(F.ceil(F.col("queue") / F.col("quantum")))).first()[0] or 1
    per_block = max(1, -(-int(rounds) // BLOCKS))

    d = made.select("grp", "part", "seq", "at", "n").join(sums, ["grp", "part"])
    d = d.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / packet))))
    d = d.withColumn("start", F.col("k") * packet).withColumn("len", F.least(F.lit(packet).cast("long"), F.col("n") - F.col("start")))
    d = d.withColumn("round", F.ceil((F.col("base") + F.col("at") + F.col("start") + F.col("len")) / F.col("quantum")))
    d = d.select("grp", "part", "seq", "start", "len", "round", F.floor(F.col("round") / per_block).alias("block"))
    turn = Window.partitionBy("block").orderBy("round", "grp", "part", "seq", "start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = d.groupBy("block").agg(F.sum("len").alias("size"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("from"))
    d = d.withColumn("end", F.sum("len").over(turn)).join(blocks, "block")
    d = d.withColumn("pos", F.col("from") + F.col("end") - F.col("len"))
    d = d.withColumn("w", F.explode(F.sequence(F.floor(F.col("pos") / window), F.floor((F.col("pos") + F.col("len") - 1) / window))))
    lo = F.greatest(F.col("pos"), F.col("w") * window)
    hi = F.least(F.col("pos") + F.col("len"), (F.col("w") + 1) * window)
    piece = F.struct((F.col("start") + lo - F.col("pos")).alias("start"), (hi - lo).alias("length"), F.col("w").alias("sequence_id"), (lo - F.col("w") * window).alias("offset"))
    pieces = d.select("part", "seq", piece.alias("p")).groupBy("part", "seq").agg(F.collect_list("p").alias("p"))
    cut = F.transform("p", lambda p: F.struct(*[p[c].alias(c) for c in ("start", "length", "sequence_id", "offset")], F.substring(F.col("ids"), (WIDTH * p["start"] + 1).cast("int"), (WIDTH * p["length"]).cast("int")).alias("ids")))
    out = made.join(pieces, ["part", "seq"]).select("doc_id", F.col("n").alias("doc_tokens"), F.when(F.col("grp") != "-", F.expr("substring(grp, 2)")).alias("source"), F.explode(cut).alias("c"))
    return out.select("doc_id", "c.start", "c.length", "c.ids", "doc_tokens", "c.sequence_id", "c.offset", "source")


def digest(pieces: DataFrame) -> DataFrame:
    out = ids_to_crc32(pieces, WIDTH)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


def op4_pack_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
