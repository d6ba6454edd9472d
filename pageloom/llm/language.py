"""Language of code-switched texts: a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import WIDTH, Words, chunked, cut_long, give_back, lean, letters, mix, prefix_hashes, split_words
from pageloom.session import materialize, table

TRIM = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…–—¡¿0123456789"
BUCKETS = 1 << 17
#: Words in a block of a chain. Blocks are worked on side by side; a longer chain's state is carried from block to block.
CHAIN = 512


def features(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features [n, m], which of them count): the word itself (lexicon), affixes of 1 to 4 letters, n-grams of 2 to 4."""
    points, n = letters(words)
    n = np.minimum(n, WIDTH)
    heads = prefix_hashes(points)
    values, real = [mix(heads[:, -1] + np.uint64(1))], [n > 0]
    for k in (1, 2, 3, 4):
        values.append(mix(heads[:, k - 1] + np.uint64(10 + k)))
        real.append(n >= k)
        at = np.clip(n[:, None] - k + np.arange(k), 0, WIDTH - 1)
        tail = np.take_along_axis(points, at, axis=1).astype(np.uint64)
        values.append(mix(prefix_hashes(np.pad(tail, ((0, 0), (0, WIDTH - k))))[:, k - 1] + np.uint64(20 + k)))
        real.append(n >= k)
    deep = points.astype(np.uint64)
    most = int(n.max()) if len(n) else 0
    for k in (2, 3, 4):
        for at in range(max(0, most - k + 1)):
            h = deep[:, at].copy()
            for j in range(1, k):
                h = h * np.uint64(1000003) + deep[:, at + j]
            values.append(mix(h + np.uint64(k << 60)))
            real.append(n >= at + k)
    return (np.stack(values, axis=1) & np.uint64(BUCKETS - 1)).astype(np.int32), np.stack(real, axis=1)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # [BUCKETS, labels]
    moves: np.ndarray  # [labels, labels]

    def emissions(self, words: pa.StringArray) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for k in range(0, len(words), 20_000):
            f, real = features(words.slice(k, 20_000))
            for j in range(f.shape[1]):
                at = np.flatnonzero(real[:, j])
                out[k + at] += self.weights[f[at, j]]
        return out


def chains(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, place in its text) of blocks of at most CHAIN words; none crosses a text."""
    sizes = np.diff(bounds)
    parts = -(-sizes // CHAIN)
    place = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(bounds[:-1], parts) + CHAIN * place
    return first, np.minimum(CHAIN, np.repeat(bounds[1:], parts) - first), place


def _unit(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _carried(local: np.ndarray, step: np.ndarray, first: np.ndarray, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(forward state before each block, backward state behind it) of blocks in text order, exact up to a factor.

    Each block of a text of several is a product of its words' matrices; a
    scan over a text's blocks, forward and back, then gives the states
    between them. Blocks of all texts are multiplied side by side.
    """
    n, k = len(first), step.shape[0]
    into, behind = np.ones((n, k), np.float32), np.ones((n, k), np.float32)
    follows = place > 0
    leads = np.append(follows[1:], False)  # another block of its text comes next
    use = np.flatnonzero(follows | leads)
    if not len(use):
        return into, behind
    use = use[np.argsort(-length[use], kind="stable")]
    matrix = np.empty((n, k, k), np.float32)
    m = np.broadcast_to(np.eye(k, dtype=np.float32), (len(use), k, k)).copy()
    m[follows[use]] = step
    for t in range(int(length[use[0]])):
        alive = int(np.searchsorted(-length[use], -t, side="left"))
        part = m[:alive] if t == 0 else m[:alive] @ step
        part = part * local[first[use[:alive]] + t][:, None, :]
        m[:alive] = part / part.sum(axis=(1, 2), keepdims=True)
    matrix[use] = m
    by_place = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[by_place], np.arange(int(place.max()) + 2))
    state = np.ones((n, k), np.float32)
    for p in range(len(cuts) - 1):
        at = by_place[cuts[p] : cuts[p + 1]]
        at = at[follows[at] | leads[at]]
        if p:
            into[at] = state[at - 1]
        state[at] = _unit((into[at][:, None, :] @ matrix[at])[:, 0])
    for p in range(len(cuts) - 2, 0, -1):
        at = by_place[cuts[p] : cuts[p + 1]]
        behind[at - 1] = _unit((matrix[at] @ behind[at][:, :, None])[:, :, 0])
    return into, behind


def marginals(scores: np.ndarray, blocks: tuple[np.ndarray, np.ndarray, np.ndarray], moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: (posterior of each word's label, expected transitions). Blocks are worked side by side."""
    first, length, place = blocks
    words, k = scores.shape
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    step = np.exp(moves - moves.max()).astype(np.float32)
    into, last = _carried(local, step, first, length, place)
    order = np.argsort(-length, kind="stable")
    first, length, follows, into, last = first[order], length[order], place[order] > 0, into[order], last[order]
    post = np.zeros((words, k), np.float32)
    pairs = np.zeros((k, k))
    steps = int(length[0]) if len(length) else 0
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]  # blocks longer than t
    ahead = []
    for t in range(steps):
        e = local[first[: alive[t]] + t]
        a = np.where(follows[:, None], e * (into @ step), e) if t == 0 else e * (ahead[-1][: alive[t]] @ step)
        ahead.append(_unit(a))
    behind = last[: alive[-1]] if steps else last
    for t in range(steps - 1, -1, -1):
        a, b = ahead[t], behind
        post[first[: alive[t]] + t] = _unit(a * b)
        eb = local[first[: alive[t]] + t] * b
        before = ahead[t - 1][: alive[t]] if t else into[follows]
        both = before[:, :, None] * step[None] * (eb if t else eb[follows])[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        if t:
            behind = last[: alive[t - 1]].copy()
            behind[: alive[t]] = _unit(eb @ step.T)
    return post, pairs


def switched(w: Words, gold: np.ndarray, every: int = 3, runs: int = 6, seed: int = 11) -> tuple[Words, np.ndarray]:
    """The texts, of which each ``every``-th is cut into runs of 8 to 60 words; these are shuffled and put together to texts of ``runs`` runs.

    So the sample has texts that switch language, and transitions between labels are learned, not only those that stay.
    """
    rng = np.random.default_rng(seed)
    whole, pool = [], []
    for i, (lo, hi) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
        if i % every:
            whole.append(np.arange(lo, hi))
        else:
            cuts = lo + np.cumsum(rng.integers(8, 61, (hi - lo) // 8 + 1))
            pool += np.split(np.arange(lo, hi), cuts[cuts < hi] - lo)
    pool = [pool[j] for j in rng.permutation(len(pool)).tolist()]
    made = whole + [np.concatenate(pool[j : j + runs]) for j in range(0, len(pool), runs)]
    at = np.concatenate([np.zeros(0, np.int64), *made]).astype(np.int64)
    return Words(np.cumsum([0, *map(len, made)]), w.codes[at], w.distinct), gold[at]


def train(texts: Sequence[str], langs: Sequence[str], rounds: int = 40, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Maximum conditional likelihood by AdaGrad over the whole sample, part of it spliced to texts that switch; a word carries its text's label."""
    labels = sorted(set(langs))
    w = cut_long(split_words(pa.array(texts, pa.string()), TRIM))
    w, gold = switched(w, np.repeat([labels.index(x) for x in langs], np.diff(w.bounds)))
    blocks = chains(w.bounds)
    k = len(labels)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(w.distinct), 10_000):
        f, real = features(w.distinct.slice(at, 10_000))
        r, c = np.nonzero(real)
        parts.append(((r + at).astype(np.int32), f[r, c]))
    rows, flat = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    model = Model(labels, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32))
    if k < 2 or not len(w.codes):
        return model
    want = np.stack([np.bincount(w.codes[gold == c], minlength=len(w.distinct)) for c in range(k)], axis=1)
    inner = np.ones(len(gold), bool)
    inner[w.bounds[:-1][w.bounds[:-1] < len(gold)]] = False
    real_moves = np.bincount((gold[:-1] * k + gold[1:])[inner[1:]], minlength=k * k).reshape(k, k) if len(gold) > 1 else np.zeros((k, k))
    seen_w, seen_m = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(rounds):
        scores = np.stack([np.bincount(rows, weights=model.weights[flat, c], minlength=len(w.distinct)) for c in range(k)], axis=1)
        post, pairs = marginals(scores[w.codes], blocks, model.moves)
        diff = np.stack([want[:, c] - np.bincount(w.codes, weights=post[:, c], minlength=len(w.distinct)) for c in range(k)], axis=1)
        g = np.stack([np.bincount(flat, weights=diff[rows, c], minlength=BUCKETS) for c in range(k)], axis=1) / len(w.codes) - decay * model.weights
        gm = (real_moves - pairs) / len(w.codes) - decay * model.moves
        seen_w += g * g
        seen_m += gm * gm
        model.weights += (rate * g / np.sqrt(seen_w)).astype(np.float32)
        model.moves += (rate * gm / np.sqrt(seen_m)).astype(np.float32)
    return model


def _smallest(per_language: int):  # noqa: ANN202
    """A mapInArrow function: the ``per_language`` smallest distinct h of each language among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column("lang").dictionary_encode()
            codes, h = langs.indices.to_numpy(), b.column("h").to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                kept[lang] = np.unique(np.append(kept.get(lang, h[:0]), h[codes == k]))[:per_language]
        yield pa.record_batch([pa.array([x for x, v in kept.items() for _ in v], pa.string()), pa.array(np.concatenate([np.zeros(0, np.int64), *kept.values()]))], names=["lang", "h"])

    return run


def fit(docs: DataFrame, usable: Column, per_language: int = 120) -> Model:
    """Train on ``per_language`` distinct whole texts of each language (all where it has fewer): those with the smallest hashes."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64(F.lit(5), F.xxhash64("text")).alias("h"))
    least = _smallest(per_language)
    # Once in each task that reads, then over what they give, dealt by hash.
    found = rows.select("lang", "h").mapInArrow(lean(least), "lang string, h long").distinct().mapInArrow(lean(least), "lang string, h long").toArrow()
    drawn = list(least(iter(found.to_batches())))[0]
    chosen = docs.sparkSession.createDataFrame(pa.Table.from_batches([drawn]))
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h").toPandas()
    model = train(sample["text"].tolist(), sample["lang"].tolist())
    del sample
    give_back()
    return model


def label(docs: DataFrame, model: Model, keep: Sequence[str], per_word: bool = False) -> DataFrame:
    """The columns ``keep`` of docs plus lang_pred, score and shares (label -> share of words); with ``per_word`` also labels, one for each word with letters.

    The label of a text is the one with the largest sum of posterior marginals
    over its words, score that label's share. A text that is null or has no
    letter is 'und' with score 0; so is every text when nothing was learned.
    Whole texts are read, each as one chain of any length; a word of more than WIDTH characters (a text without
    blanks) is several words of the chain, which share three characters so
    that no n-gram is lost. Equally large sums go to the label first by code
    point. Rows are independent and nothing is shuffled: repeated rows give
    equal results, an empty table no rows. Columns of ``keep`` that are named as one of the added are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in keep if c.lower() not in ("lang_pred", "score", "shares", *["labels"] * per_word)]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", T.ArrayType(T.DoubleType()))]
    added += [T.StructField("labels", T.ArrayType(T.StringType()))] * per_word
    schema = T.StructType([*[docs.schema[c] for c in names], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.labels)
        for batch in batches:
            for b in chunked(batch):
                w = cut_long(split_words(b.column("text"), TRIM))
                has = pc.match_substring_regex(w.distinct, r"\pL").to_numpy(zero_copy_only=False)[w.codes]
                kept = np.concatenate([[0], np.cumsum(has)])
                bounds, codes = kept[w.bounds], w.codes[has]
                total = np.zeros((b.num_rows, max(k, 1)))
                if k and len(codes):
                    post, _ = marginals(m.emissions(w.distinct)[codes], chains(bounds), m.moves)
                    run_ = np.concatenate([np.zeros((1, k)), np.cumsum(post, axis=0, dtype=np.float64)])
                    total = run_[bounds[1:]] - run_[bounds[:-1]]
                size = np.diff(bounds)
                share = total / np.maximum(size, 1)[:, None]
                best = share.argmax(axis=1)
                none = (size == 0) | (k == 0)
                pred = np.array([*m.labels, "und"], dtype=object)[np.where(none, k, best)]
                score = np.where(none, 0.0, np.clip(share[np.arange(len(best)), best], 0, 1))
                out = [*[b.column(c) for c in names], pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(share.tolist(), pa.list_(pa.float64()))]
                if per_word:
                    each = np.array([*m.labels, "und"], dtype=object)[post.argmax(axis=1) if k and len(codes) else np.full(len(codes), k)]
                    out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(each.tolist(), pa.string())))
                yield pa.record_batch(out, names=[f.name for f in schema])

    source = docs.select(*dict.fromkeys([*names, "text"]))
    return source.mapInArrow(lean(run), schema)


def held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == rest, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out(4, 2))
    found = materialize(label(docs, model, ["doc_id"]), "languages")
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
