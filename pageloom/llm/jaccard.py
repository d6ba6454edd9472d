"""Jaccard join of texts on word shingles by chosen paths."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.words import WIDTH, chunked, give_back, lean, letters, mix, sliced, split_words
from pageloom.operators.graph import connected_components
from pageloom.session import materialize, settle, shared_dir, table

SHINGLE, THRESHOLD = 5, 0.8
#: Sampled tokens of a set: the smallest under so many hash functions.
SAMPLES = 64
#: Largest bucket that is compared without another split, deepest path, rows of a block.
SMALL, DEPTH, BLOCK = 64, 4, 512
#: Parts in which a bucket is counted, and shingles of a block's sets on average at most.
SALTS, BLOCK_SHINGLES = 32, 4_000_000
#: A pair goes on to the exact check if this share of sampled tokens agrees. At a similarity
#: of 0.8 the share is 0.8 with deviation 0.05, so less is 4.4 deviations away.
LEAST_SHARED = 0.58
#: Bits of the filter that decides which texts are read again: a fixed size, 2 MB.
FILTER_BITS = 24
_RNG = np.random.default_rng(1803)
_XOR = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_MIX = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)


def runs_for(recall: float, similarity: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs until a pair at ``similarity`` that is split ``depth`` times is met with probability ``recall``.

    All runs draw from the same SAMPLES tokens, of which k agree (binomially):
    the chance to be met is that of k's runs, averaged over k. A pair that
    agrees in a smaller share than LEAST_SHARED counts as lost, and no number of runs makes up for it.
    """
    k = np.arange(SAMPLES + 1)
    share = np.array([math.comb(SAMPLES, i) * similarity**i * (1 - similarity) ** (SAMPLES - i) for i in k.tolist()])
    same = k / SAMPLES
    q = np.ones(SAMPLES + 1)
    for _ in range(depth):
        q = 0.75 * same * q + 0.25 * (1 - (1 - same * q) ** 2)
    share = np.where(k >= math.ceil(LEAST_SHARED * SAMPLES), share, 0.0)
    if share.sum() <= recall:
        raise ValueError(f"a recall of {recall} is out of reach with {SAMPLES} samples")
    runs = 1
    while (share * (1 - (1 - q) ** runs)).sum() < recall:
        runs += 1
    return runs


def word_hashes(words: pa.StringArray) -> np.ndarray:
    points, n = letters(words)
    h = np.zeros(len(n), np.uint64)
    for k in range(min(WIDTH, int(n.max()) if len(n) else 0)):
        h = np.where(n > k, (h + points[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), h)
        h ^= np.where(n > k, h >> np.uint64(29), np.uint64(0))
    for k in np.flatnonzero(n > WIDTH).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(words[k].as_py().encode(), digest_size=8).digest(), "little")
    return mix(h)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all texts' shingle sets, sorted, one after the other; size of each).

    Words are split at white space, in lower case. A text of fewer than
    SHINGLE words has one shingle, of all its words; one without words none.
    """
    w = split_words(texts, "")
    full = (pc.binary_length(w.distinct).to_numpy() > 0)[w.codes] if len(w.codes) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(full)])
    bounds, h = kept[w.bounds], sliced(word_hashes, w.distinct)[w.codes[full]]
    size = np.diff(bounds)
    parts, count = [], np.zeros(len(size), np.int64)
    rolled = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + (h[k : len(h) - SHINGLE + 1 + k] if len(h) >= SHINGLE else h[:0])
    rolled = mix(rolled)
    for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if hi - lo >= SHINGLE:
            s = np.sort(rolled[lo : hi - SHINGLE + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif hi > lo:
            value = hi - lo
            for x in h[lo:hi].tolist():
                value = (value * 0xD6E8FEB86659FD93 + x) % (1 << 64)
            s = mix(np.array([value], np.uint64))
        else:
            continue
        parts.append(s)
        count[i] = len(s)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), count


def set_keys(sets: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell sets apart; 0 for the empty set."""
    stop = np.cumsum(count)
    out = []
    for salt in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets * np.uint64(2 * salt + 1) + np.uint64(salt)), dtype=np.uint64)])
        out.append((total[stop] - total[stop - count]).view(np.int64))
    return out[0], out[1]


def sample(sets: np.ndarray, count: np.ndarray) -> np.ndarray:
    """[texts with a set, SAMPLES] sampled tokens."""
    has = count > 0
    start = (np.cumsum(count) - count)[has]
    low = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(start), SAMPLES), np.uint32)
    for k in range(SAMPLES):
        y = (low ^ _XOR[k]) * _MUL[k]
        y ^= y >> np.uint32(15)
        y *= _MIX[k]
        out[:, k] = np.minimum.reduceat(y, start) if len(start) else 0
    return out.view(np.int32)


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), doc_id), F.lit(1 << FILTER_BITS))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in chunked(batch):
            sets, count = shingles(b.column("text"))
            k1, k2 = set_keys(sets, count)
            sig = sample(sets, count)
            at = np.concatenate([[0], np.cumsum(SAMPLES * (count > 0))]).astype(np.int32)
            yield pa.record_batch([b.column("doc_id"), b.column("th"), pa.array(k1), pa.array(k2), pa.array(count), pa.ListArray.from_arrays(pa.array(at), pa.array(sig.ravel()))], names=["doc_id", "th", "k1", "k2", "n", "sig"])


def _components(near: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row."""
    root = np.arange(len(near))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(near)).min(axis=1, initial=len(near)))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _grouped(keys: list[str], handle):  # noqa: ANN001, ANN202
    """A mapInArrow function that hands each run of rows with equal keys, in sorted partitions, to ``handle``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit(t: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
            found = [handle(t.slice(lo, hi - lo)) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True) if hi - lo > 1]
            found = [f for f in found if f is not None and len(f[0])]
            if found:
                names = ["rid", "root", "links"][: len(found[0])]
                yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)], names=names)

        for b in batches:
            t = pa.Table.from_batches([*held, b]).combine_chunks()
            k = np.stack([t.column(c).to_numpy() for c in keys], axis=1)
            cut = (np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist()
            if cut:
                yield from emit(t, [0, *cut])
            held = t.slice(cut[-1] if cut else 0).to_batches()
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield from emit(t, [0, t.num_rows])

    return run


def _similar(rows: pa.Table) -> np.ndarray:
    """Pairs of rows whose sampled tokens mostly agree and whose sizes allow the threshold."""
    sig = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, SAMPLES)
    agree = np.zeros((len(sig), len(sig)), np.uint8)
    for k in range(SAMPLES):
        agree += sig[:, k, None] == sig[None, :, k]
    n = rows.column("n").to_numpy().astype(np.float64)
    near = (agree >= math.ceil(LEAST_SHARED * SAMPLES)) & (np.minimum.outer(n, n) >= THRESHOLD * np.maximum.outer(n, n) - 1e-9)
    np.fill_diagonal(near, False)
    left = rows.column("left").to_numpy()
    if not left.all():
        near &= left[:, None] != left[None, :]
    return near


def _candidates(rows: pa.Table) -> tuple[np.ndarray, np.ndarray] | None:
    near = _similar(rows)
    use = np.flatnonzero(near.any(axis=1))
    if not len(use):
        return None
    rid = rows.column("rid").to_numpy()[use]
    return rid, rid[_components(near[np.ix_(use, use)])]


def _exact(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    near = _similar(rows)
    use = np.flatnonzero(near.any(axis=1))
    if not len(use):
        return None
    near = near[np.ix_(use, use)]
    column = rows.column("shingles").combine_chunks()
    sets = [np.frombuffer(column[k].as_buffer(), np.uint64) for k in use.tolist()]
    n = np.array([len(s) for s in sets], np.float64)
    i, j = np.nonzero(np.triu(near))
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n.astype(np.int64))
    dense = len(i) > 4000
    if dense:
        _, at, uses = np.unique(flat, return_inverse=True, return_counts=True)
        many = uses >= 2
        place = np.cumsum(many) - 1
        keep = many[at]
        at, owner = place[at[keep]], owner[keep]
        common = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        for lo in range(0, int(many.sum()), 4096):
            part = slice(*np.searchsorted(at, [lo, lo + 4096]))
            x = np.zeros((len(sets), 4096), np.float32)
            x[owner[part], at[part] - lo] = 1
            common += x @ x.T
        inter = common[i, j].astype(np.float64)
    else:
        inter = np.empty(len(i))
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            small, large = (sets[a], sets[b]) if len(sets[a]) <= len(sets[b]) else (sets[b], sets[a])
            inter[k] = (large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum()
    good = inter >= THRESHOLD * (n[i] + n[j] - inter) - 1e-9
    linked = np.zeros_like(near)
    linked[i[good], j[good]] = linked[j[good], i[good]] = True
    rid, copies = rows.column("rid").to_numpy()[use], rows.column("copies").to_numpy()[use]
    found = np.flatnonzero(linked.any(axis=1))
    return rid[found], rid[_components(linked)][found], (linked @ copies)[found]


def _blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (with their group's size m, and its shingles where they are carried) dealt to all pairs of blocks of their group that they take part in."""
    least = F.ceil(F.col("m") / BLOCK)
    if "total" in rows.columns:
        least = F.least(F.greatest(least, F.ceil(F.col("total") / BLOCK_SHINGLES)), F.col("m"))
    d = rows.withColumn("nb", least.cast("int")).withColumn("b", F.pmod(F.xxhash64(F.lit(4), "rid"), F.col("nb")).cast("int"))
    d = d.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return d.select(*keys, "rid", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), (F.col("b") <= F.col("o")).alias("left"))


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    order = [*keys, "bi", "bj"]
    return rows.repartition(*order).sortWithinPartitions(*order)


def paths(reps: DataFrame, runs: int) -> DataFrame:
    """(path, rid, m): leaves of the chosen-path trees with at least two sets.

    In each of ``runs`` trees a node samples one of the SAMPLES tokens, and
    with probability 1/4 a second one (1/similarity on average), by a hash of
    its path; its sets go on by the token that they have there. Buckets of at
    most SMALL sets, or at depth DEPTH, are leaves.
    """
    shared_dir(reps.sparkSession)
    out, level = None, 1
    at = reps.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))).withColumn("path", F.xxhash64(F.lit(1), "run"))
    while True:
        if level == 1:
            first, second = 2 * F.col("run") % SAMPLES, (2 * F.col("run") + 1) % SAMPLES
        else:
            first, second = (F.pmod(F.xxhash64(F.lit(k), "path"), F.lit(SAMPLES)).cast("int") for k in (11, 12))
        chosen = F.when(F.pmod(F.xxhash64(F.lit(13), "path"), F.lit(4)) == 0, F.array(first, second)).otherwise(F.array(first))
        at = at.withColumn("c", F.explode(F.array_distinct(chosen)))
        at = at.select("rid", F.xxhash64("path", "c", F.element_at("sig", F.col("c") + 1)).alias("path"))
        # A bucket that holds many sets is counted, and told its size, in SALTS parts.
        at = at.withColumn("salt", F.pmod(F.xxhash64(F.lit(6), "rid"), F.lit(SALTS)).cast("int"))
        parts = at.groupBy("path", "salt").agg(F.count("*").alias("c")).groupBy("path").agg(F.sum("c").alias("m"), F.collect_list("salt").alias("salts"))
        full = parts.where("m > 1").select("path", "m", F.explode("salts").alias("salt"))
        at = at.join(full, ["path", "salt"]).drop("salt").checkpoint()
        settle(reps.sparkSession)
        done = (F.col("m") <= SMALL) | F.lit(level == DEPTH)
        leaves = at.where(done).select("path", "rid", "m")
        out = leaves if out is None else out.unionByName(leaves)
        if level == DEPTH:
            return out
        at = at.where(~done).select("path", "rid").join(reps, "rid")
        level += 1


def near_duplicates(docs: DataFrame, recall: float = 0.9999) -> DataFrame:
    """doc_id, th, class_id, n_links, component for every row of docs(doc_id, text).

    Texts link when the Jaccard similarity of their sets of five-word shingles
    is at least 0.8. Equal sets are one class, met once whatever the number
    of its copies. Candidates come from chosen paths (``paths``), repeated
    until a pair at the threshold is met with probability ``recall``; small
    buckets are compared by brute force on sampled tokens in blocks of BLOCK
    sets. What they find is only used as spanning links; the sets that hang
    together so are read again, and each pair among them whose samples agree
    is checked exactly, in blocks, once. No bucket's pairs are listed, nothing
    is capped.

    class_id is the smallest doc_id of the texts that links connect, n_links
    the number of other rows linked directly (copies included). th is
    xxhash64(text), component the class's own number (null: no words). Text that is null or has no words links with nothing and
    is its own class. Shorter texts than five words are one shingle. Null
    doc_id takes part; a class of such rows alone has a null id. Texts of any
    length are read whole; blocks hold fewer sets where these are large. An empty
    table gives no rows; other columns are ignored, whatever their names.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = materialize(d.mapInArrow(lean(_sketch), "doc_id long, th long, k1 long, k2 long, n long, sig array<int>"), "jaccard-samples")
    classes = rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.first("sig").alias("sig"))
    classes = materialize(classes.withColumn("rid", F.monotonically_increasing_id()), "jaccard-classes")
    leaves = paths(classes.select("rid", "sig"), runs_for(recall))
    met = _blocks(leaves, ["path"]).join(classes.select("rid", "n", "sig"), "rid")
    spans = materialize(_dealt(met, ["path"]).mapInArrow(lean(_grouped(["path", "bi", "bj"], _candidates)), "rid long, root long"), "jaccard-spans")
    settle(docs.sparkSession)
    hang = connected_components(spans, "rid", "root").select(F.col("id").alias("rid"), F.col("component").alias("comp")).checkpoint()
    chosen = hang.join(classes, "rid").select("rid", "comp", "k1", "k2", "n", "copies", "sig", "least")

    words = chosen.select(_slot(F.col("least")).alias("s")).groupBy((F.col("s") / 64).cast("long").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found = words.toPandas()  # at most one row per word of the filter
    bits[found["w"].to_numpy()] = found["bits"].to_numpy()
    del found
    give_back()
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column("s").to_numpy()
            hit = (held.value[s >> 6] >> (s & 63)) & 1 == 1
            for b in chunked(batch.filter(pa.array(hit))):
                sets, count = shingles(b.column("text"))
                k1, k2 = set_keys(sets, count)
                at = pa.array(np.concatenate([[0], 8 * np.cumsum(count)]).astype(np.int32)).buffers()[1]
                yield pa.record_batch([pa.array(k1), pa.array(k2), pa.array(count), pa.Array.from_buffers(pa.binary(), b.num_rows, [None, at, pa.py_buffer(sets.tobytes())])], names=["k1", "k2", "n", "shingles"])

    read = docs.select(_slot(F.col("doc_id").cast("long")).alias("s"), "text").mapInArrow(lean(again), "k1 long, k2 long, n long, shingles binary")
    full = read.join(chosen, ["k1", "k2", "n"]).groupBy("rid").agg(*[F.first(c).alias(c) for c in ("comp", "n", "copies", "sig", "shingles")])
    full = materialize(full, "jaccard-sets")
    settle(docs.sparkSession)
    sizes = full.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1")
    dealt = _blocks(full.select("rid", "comp").join(sizes, "comp"), ["comp"]).join(full.drop("comp"), "rid")
    links = materialize(_dealt(dealt, ["comp"]).mapInArrow(lean(_grouped(["comp", "bi", "bj"], _exact)), "rid long, root long, links long"), "jaccard-links")
    per_class = links.groupBy("rid").agg(F.sum("links").alias("links"))
    comp = connected_components(links, "rid", "root").withColumnRenamed("id", "rid")
    named = classes.select("rid", "k1", "k2", "n", "copies", "least").join(per_class, "rid", "left").join(comp, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    # Joined to itself here, and twice by one_of_each: one plan of all of it would be more than the driver has room for beside many tasks.
    named = materialize(named, "jaccard-named")
    settle(docs.sparkSession)
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    named = named.join(least, "component").select("k1", "k2", "n", "class_id", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = rows.where("n = 0").select("doc_id", "th", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component"))
    return rows.where("n > 0").join(named, ["k1", "k2", "n"]).select("doc_id", "th", "class_id", "n_links", "component").unionByName(own)


def one_of_each(docs: DataFrame, recall: float = 0.9999) -> DataFrame:
    """The rows of docs without near copies: of each class the row of the smallest (doc_id, text hash) stays.

    Rows without words all stay. Of rows equal in doc_id and text one stays,
    that of the smallest hash over all its columns. All columns are kept, whatever their names; an empty table gives no rows.
    """
    def key(d: DataFrame) -> DataFrame:
        return d.withColumns({"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "no_id": F.col("doc_id").isNull(), "words": F.coalesce("th", F.lit(0))})

    keys = ["id", "no_id", "words"]
    found = materialize(near_duplicates(docs, recall), "jaccard-found")
    settle(docs.sparkSession)
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("f")).select("f.doc_id", "f.th", F.lit(True).alias("single"))
    bare = found.where("component IS NULL").select("doc_id", "th", F.lit(False).alias("single")).distinct()
    kept = key(first.unionByName(bare)).select(*keys, "single").distinct()
    # The caller's row is one column, so that its names cannot meet those used here.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    d = docs.select(F.struct(*columns).alias("doc"), "doc_id", F.xxhash64("text").alias("th"), F.xxhash64(*columns).alias("whole"))
    d = key(d).drop("doc_id", "th").join(kept, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("whole"))
    return d.withColumn("rank", rank).where(~F.col("single") | (F.col("rank") == 1)).select("doc.*")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("kept"))


#: All pairs that share a shingle, counted: for small tables only.
OP3_SQL = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS MATERIALIZED (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS MATERIALIZED (SELECT i, j FROM common JOIN n x ON x.doc_id = i JOIN n y ON y.doc_id = j WHERE c >= {THRESHOLD} * (x.n + y.n - c) - 1e-9),
sym AS MATERIALIZED (SELECT i AS a, j AS b FROM pairs UNION ALL SELECT j, i FROM pairs),
reach AS (SELECT a, b FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON s.a = r.b),
class AS (SELECT a AS doc_id, least(a, min(b)) AS class_id FROM reach GROUP BY a),
links AS (SELECT a AS doc_id, count(*) AS n_links FROM sym GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN class USING (doc_id) LEFT JOIN links USING (doc_id)
"""
