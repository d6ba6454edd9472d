"""Toxicity of texts read through a noisy channel.

Leetspeak, letters spaced out and repeated letters are taken for noise over a
word that was meant: Viterbi decoding of a character lattice under a character
trigram model of the corpus restores it, and a linear model over the restored
words scores the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import WIDTH, Words, chunked, give_back, lean, letters, mix, points, prefix_hashes, sliced, split_words
from pageloom.session import materialize, small_batches, table

TRIM = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”„‘’…–—¡¿"
#: Letters that a character may stand for. Fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "§": "s",
}
#: Signs among them. At a word's edge such a sign may be a letter or punctuation.
SIGNS = "".join(c for c in LEET if not c.isalnum())
#: What is taken off the ends of words whose edges are still to be read.
OUTER = "".join(c for c in TRIM if c not in SIGNS)
#: Costs in nats: a substitution, a dropped mark, a dropped repetition, a blank put in or left out.
SUBSTITUTE, DROP_MARK, DROP_REPEAT, BLANK = 1.0, 1.5, 1.2, 2.5
#: Characters that spacing uses.
MARKS = frozenset(".-_*~'\"^,/\\")
#: Words that the channel can have touched: marks or digits among letters, or a letter three times. Each search is linear.
_LETTER, _MARK, _TRIPLE = re.compile(r"[^\W\d_]"), re.compile(r"[\d@$!|+(<€£§.\-_*~'\"^,/\\]"), re.compile(r"([^\W\d_])\1\1")
#: Longest word whose decoding is remembered.
LONGEST = 40
SIZE = 1 << 22


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, sorted; their sums)."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def _count(table_: tuple[np.ndarray, np.ndarray], code: int) -> int:
    at = int(table_[0].searchsorted(code))
    return int(table_[1][at]) if at < len(table_[0]) and table_[0][at] == code else 0


class CharModel:
    """Interpolated character trigrams; 0 is the edge of a word.

    ``counts`` is a trigram's count, or (codes, counts): codes of 21 bits a
    character. All of them are held, sorted, at 16 bytes each.
    """

    def __init__(self, counts: dict[str, int] | tuple[np.ndarray, np.ndarray], remembered: int = 500_000):
        if isinstance(counts, dict):
            codes = np.array([ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in counts], np.int64)
            counts = codes, np.array(list(counts.values()), np.int64)
        codes, n = self.three = _summed(*counts)
        self.two, self.one = _summed(codes >> 21, n), _summed(codes >> 21 & 0x1FFFFF, n)
        self.zero, self.last = _summed(codes & (1 << 42) - 1, n), _summed(codes & 0x1FFFFF, n)
        self.all = int(n.sum()) or 1
        self.most, self._logs = remembered, {}

    def cost(self, context: str, c: str) -> float:
        """-log P(c | the two characters before)."""
        gram = context + c
        if gram not in self._logs:
            if len(self._logs) >= self.most:
                self._logs.clear()
            x, y, z = ord(context[0]), ord(context[1]), ord(c)
            p = (_count(self.last, z) + 0.5) / (self.all + 0.5 * (len(self.last[0]) + 1))
            p = (_count(self.zero, y << 21 | z) + 20 * p) / (_count(self.one, y) + 20)
            p = (_count(self.three, x << 42 | y << 21 | z) + 20 * p) / (_count(self.two, x << 21 | y) + 20)
            self._logs[gram] = -math.log(p)
        return self._logs[gram]


EDGE = "\0"


def decode(word: str, model: CharModel, spaced: bool = False, inner: tuple[int, int] | None = None) -> str:
    """The likeliest words behind ``word`` (lower case), by Viterbi over its lattice.

    A state is the last two restored letters. Each character may be itself, a
    letter that it stands for, nothing if it is a mark, or nothing if it
    repeats the one before. With ``spaced``, ``word`` is a run of letters that
    stood alone, and blanks may be put between any two. Signs outside of
    ``inner`` (start, stop) may also be punctuation, that is nothing.
    """
    lo, hi = inner or (0, len(word))
    # Of each state the cost, and the parts made so far as a chain of pairs.
    states: dict[str, tuple[float, tuple | None]] = {EDGE * 2: (0.0, None)}
    for k, c in enumerate(word):
        if len(states) == 1 and not spaced and c.isalpha() and (not k or word[k - 1] != c):  # nothing to choose
            ((context, (cost, made)),) = states.items()
            states = {context[1] + c: (cost + model.cost(context, c), (made, c))}
            continue
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options.append((c, 0.0))
        for x in LEET.get(c, ""):
            options.append((x, SUBSTITUTE))
        if c in MARKS or not c.isalnum() and (c not in LEET or not lo <= k < hi):
            options.append(("", DROP_MARK))
        if k and word[k - 1] == c and c.isalnum():
            options.append(("", DROP_REPEAT))
        if not options:
            options.append(("", DROP_MARK + SUBSTITUTE))
        new: dict[str, tuple[float, tuple | None]] = {}
        for context, (cost, made) in states.items():
            for x, extra in options:
                ways = [(context, cost + extra, x)]
                if spaced and x and context[1] != EDGE:
                    ways.append((EDGE * 2, cost + extra + BLANK + model.cost(context, EDGE), " " + x))
                for before, so_far, part in ways:
                    state = before[1] + x if x else before
                    total = so_far + model.cost(before, x) if x else so_far
                    if state not in new or total < new[state][0]:
                        new[state] = (total, (made, part) if part else made)
        states = new
    _, made = min(((cost + model.cost(context, EDGE), made) for context, (cost, made) in states.items()), key=lambda s: s[0])
    parts = []
    while made:
        made, part = made
        parts.append(part)
    return "".join(reversed(parts))


def touched(word: str) -> bool:
    return bool(_MARK.search(word) and _LETTER.search(word) or _TRIPLE.search(word))


_EDGE = "^[" + re.escape(SIGNS) + "]|[" + re.escape(SIGNS) + "]$"


def maybe_touched(words: pa.StringArray) -> np.ndarray:
    """Of which words touched() may hold: marks and letters, or any character three times."""
    has = lambda pattern: pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)
    found = np.array(has(r"[\p{Nd}@$!|+(<€£§.\-_*~'\"^,/\\]") & has(r"[\pL\p{Nl}\p{No}]"))
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    flat = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: int(offsets[-1])] if len(words) else np.zeros(0, np.uint8)
    for size in (1, 2, 3, 4) if len(flat) and flat.max() > 127 else (1,):  # bytes of a character
        same = flat[size:] == flat[:-size]
        for _ in range(2 * size - 1):
            same = same[1:] & same[:-1] if len(same) else same
        at = np.flatnonzero(same)
        word = np.searchsorted(offsets, at, side="right") - 1
        inside = (word >= 0) & (word < len(words))
        at, word = at[inside], word[inside]
        found[word[at + 3 * size <= offsets[word + 1]]] = True
    return found


def edges(word: str) -> tuple[int, int]:
    """(start, stop) of a word without the signs at its ends; of signs alone, (0, 0)."""
    lo = len(word) - len(word.lstrip(SIGNS))
    return (lo, len(word.rstrip(SIGNS))) if lo < len(word) else (0, 0)


def split_edges(texts: pa.Array) -> tuple[Words, Words]:
    """(words without TRIM at their ends, the same words with the signs at their ends)."""
    wide = split_words(texts, OUTER)
    plain = pc.utf8_trim(wide.distinct, characters=TRIM).dictionary_encode()
    return Words(wide.bounds, plain.indices.to_numpy().astype(np.int64)[wide.codes], plain.dictionary), wide


class Restorer:
    """Words of texts with what the channel did undone; decodings are remembered, up to a bound."""

    def __init__(self, model: CharModel, remembered: int = 200_000):
        self.model, self.known, self.most = model, {}, remembered

    def word(self, word: str, spaced: bool = False, inner: tuple[int, int] | None = None) -> str:
        if len(word) > LONGEST:
            return decode(word, self.model, spaced, inner)
        key = (word, spaced, inner)
        if key not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[key] = decode(word, self.model, spaced, inner)
        return self.known[key]

    def readings(self, word: str, spaced: bool = False) -> set[str]:
        """What a word may mean if signs at its ends are letters.

        Of the signs at either end the inner 0, 1, 2, 3 are letters and the
        others punctuation, or each of them is what is likelier; not read here
        is the word without any.
        """
        lo, hi = edges(word)
        before, after = lo, len(word) - hi
        parts: set[tuple[str, tuple[int, int] | None]] = set()
        for i in range(min(before, 3) + 1):
            parts |= {(word[lo - i : hi + j], None) for j in range(min(after, 3) + 1)}
            if after > 3:
                parts.add((word[lo - i :], (0, hi - lo + i)))
        if before > 3:
            parts |= {(word[: hi + j], (lo, hi + j)) for j in range(min(after, 3) + 1)}
        if before > 3 and after > 3:
            parts.add((word, (lo, hi)))
        return {self.word(w, spaced, inner) for w, inner in parts if w and w != word[lo:hi]} - {""}

    def text(self, text: str) -> str:
        """A text with every touched word and every run of lone letters restored."""
        out: list[str] = []
        lone: list[tuple[str, str]] = []
        for w in [*text.lower().split(), ""]:
            wide, plain = w.strip(OUTER), w.strip(TRIM)
            if len(wide) == 1 or len(plain) == 1 and plain.isalnum():
                lone.append((wide if len(wide) == 1 else plain, w))
                continue
            if lone:
                run = "".join(c for c, _ in lone)
                signs = any(c in SIGNS for c in run)
                if len(lone) < 3 or signs and not any(c.isalpha() for c in run):
                    out.extend(x if c in SIGNS else c for c, x in lone)
                else:
                    out.append(self.word(run, True, edges(run) if signs else None))
                lone = []
            if wide != plain and any(c.isalpha() for c in wide):
                new = self.word(wide, False, edges(wide))
                out.append(new if new != plain else w)
            else:
                out.append(self.word(plain) if touched(plain) else w)
        return " ".join(out[:-1])

    def extra(self, w: Words, wide: Words | None = None) -> tuple[np.ndarray, list[str]]:
        """(text, word) pairs that restoring adds to the texts' own words ``w``; ``wide`` are they with the signs at their ends."""
        return self.restored(w, wide)[1:]

    def restored(self, w: Words, wide: Words | None = None) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(which of the texts' words stand as they are, and (text, word) pairs for the others).

        A word that was decoded to another and a letter of a decoded run
        give way to what was meant. Signs at a word's ends may be punctuation, so
        there the word without them stays and its readings come beside it.
        """
        stays = np.ones(len(w.codes), bool)
        rows: list[int] = []
        found: list[str] = []
        start, made = np.zeros(len(w.distinct) + 1, np.int64), []
        for k in np.flatnonzero(maybe_touched(w.distinct)).tolist():
            word = w.distinct[k].as_py()
            if touched(word):
                new = self.word(word)
                if new != word:
                    start[k + 1] = 1
                    made.append(new)
        _per_text(w, start, made, rows, found)
        stays &= ~(start[1:] > 0)[w.codes] if len(w.codes) else stays
        self._runs(w, False, rows, found, stays)
        if wide is not None:
            start, made = np.zeros(len(wide.distinct) + 1, np.int64), []
            edge = pc.match_substring_regex(wide.distinct, _EDGE).to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(edge).tolist():
                new = sorted(self.readings(wide.distinct[k].as_py()))
                start[k + 1] = len(new)
                made += new
            _per_text(wide, start, made, rows, found)
            self._runs(wide, True, rows, found, stays)
        return stays, np.array(rows, np.int64), found

    def _runs(self, w: Words, signs: bool, rows: list[int], found: list[str], stays: np.ndarray) -> None:
        """Runs of lone characters; with ``signs`` only those with a sign in them, in all their readings."""
        single = (pc.utf8_length(w.distinct).to_numpy() == 1)[w.codes] if len(w.distinct) else np.zeros(0, bool)
        if single.sum() <= 2:
            return
        # A run never crosses a text: the first word of each text starts one.
        starts = np.zeros(len(single) + 1, bool)
        starts[w.bounds[:-1]] = True
        begin = np.flatnonzero(single & (starts[:-1] | ~np.append(False, single[:-1])))
        end = np.flatnonzero(single & (starts[1:] | ~np.append(single[1:], False))) + 1
        for lo, hi in zip(begin.tolist(), end.tolist(), strict=True):
            if hi - lo > 2:
                run = "".join(w.distinct.take(pa.array(w.codes[lo:hi])).to_pylist())
                row = int(np.searchsorted(w.bounds, lo, side="right") - 1)
                if signs and not any(c in SIGNS for c in run):
                    continue
                # Without the signs at its ends a run may still have some within.
                stays[lo:hi] = False
                read = {self.word(run.strip(SIGNS), True), *self.readings(run, True)} if signs else {self.word(run, True)}
                for word in sorted({x for r in read for x in r.split(" ")}):
                    rows.append(row)
                    found.append(word)


def _per_text(w: Words, start: np.ndarray, made: list[str], rows: list[int], found: list[str]) -> None:
    """Adds, for each word of each text, what was made of it: start[k + 1] words of ``made`` for distinct word k."""
    if not made:
        return
    count = start[1:]
    first = np.cumsum(count) - count
    use = np.flatnonzero(count[w.codes])
    n = count[w.codes[use]]
    at = np.repeat(first[w.codes[use]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    rows += np.repeat(np.searchsorted(w.bounds, use, side="right") - 1, n).tolist()
    found += [made[k] for k in at.tolist()]


def hashes(words: pa.StringArray) -> np.ndarray:
    """[n, 6] keys: the word, and its beginnings of 3 to 7 letters (0: too short)."""
    return sliced(_hashes, words)


def _hashes(words: pa.StringArray) -> np.ndarray:
    codes, n = letters(words)
    heads = prefix_hashes(codes)
    keys = [mix(heads[:, -1] + n.astype(np.uint64) * np.uint64(7919) + np.uint64(1))]
    for k in (3, 4, 5, 6, 7):
        keys.append(np.where(n > k, mix(heads[:, k - 1] + np.uint64(100 + k)), np.uint64(0)))
    for k in np.flatnonzero(n > WIDTH).tolist():  # longer words whole
        keys[0][k] = int.from_bytes(hashlib.blake2b(words[k].as_py().encode(), digest_size=8).digest(), "little")
    keys[0][n == 0] = 0
    return np.stack(keys, axis=1).view(np.int64)


def text_keys(b: pa.RecordBatch, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs of a batch's texts, restored words included."""
    w, wide = split_edges(b.column("text"))
    stays, more_rows, more = restorer.restored(w, wide)
    keys = hashes(w.distinct)[w.codes[stays]]
    rows = np.repeat(np.arange(b.num_rows), np.diff(w.bounds))[stays]
    if len(more):
        keys = np.concatenate([keys, hashes(pa.array(more, pa.string()))])
        rows = np.concatenate([rows, more_rows])
    rows, keys = np.repeat(rows, keys.shape[1]), keys.ravel()
    use = keys != 0
    rows, keys = rows[use], keys[use]
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[first], keys[first]


def char_model(docs: DataFrame) -> CharModel:
    """Trigram counts over the words of every text: pre-aggregated in each task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for b in chunked(batch):
                w = split_words(b.column("text"), TRIM)
                clean = np.flatnonzero(pc.match_substring_regex(w.distinct, r"^\pL+$").to_numpy(zero_copy_only=False))
                uses = np.bincount(w.codes, minlength=len(w.distinct))[clean]
                for lo in range(0, len(clean), 50_000):
                    some = uses[lo : lo + 50_000]
                    flat, size = points(pc.binary_join_element_wise(w.distinct.take(pa.array(clean[lo : lo + 50_000])).cast(pa.string()), "\0\0", ""))
                    flat = np.concatenate([[0, 0], flat.astype(np.int64)])  # two edges before, between and after words
                    grams = (flat[:-2] << 42) | (flat[1:-1] << 21) | flat[2:]
                    real = (flat[1:-1] != 0) | (flat[2:] != 0)
                    k, at = np.unique(grams[real], return_inverse=True)
                    n = np.bincount(at, weights=np.repeat(some, size - 1), minlength=len(k)).astype(np.int64)
                    for g, c in zip(k.tolist(), n.tolist(), strict=True):
                        total[g] = total.get(g, 0) + c
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["g", "n"])

    summed = docs.select("text").where(F.col("text").isNotNull()).mapInArrow(lean(run), "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):  # whole texts pass through Python
        made = summed.toArrow()
    return CharModel((made.column("g").to_numpy(), made.column("n").to_numpy()))


@dataclass
class Model:
    chars: CharModel
    keys: np.ndarray  # sorted
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, usable: Column, most: int = 6000, most_keys: int = 20_000, least_gain: float = 25.0) -> Model:
    """Learn from labels (doc_id, toxic): at most ``most`` distinct texts of either class, drawn by hash of the text.

    Word and word-beginning keys are kept whose likelihood ratio (G squared)
    for the class is at least ``least_gain``; over these a logistic model with
    L2 penalty is fitted, the rarer class up to three times as heavy. Equal
    texts of one label count once. Several labels of one document: the largest holds.
    """
    spark = docs.sparkSession
    chars = char_model(docs)
    named = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(usable)
    texts = docs.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64(F.lit(9), F.xxhash64("text")).alias("h"))
    # Of equal texts of one label one document stands for all.
    pairs = texts.select("doc_id", "h").join(named, "doc_id").groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id"))
    drawn = [pairs.where(F.col("toxic") == c).orderBy("h").limit(most) for c in (0, 1)]
    sample = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), ["doc_id", "h"]).select("toxic", "text").dropDuplicates(["toxic", "text"])
    shared = spark.sparkContext.broadcast(chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            for b in chunked(batch):
                rows, keys = text_keys(b, restorer)
                cut = np.searchsorted(rows, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.record_batch([b.column("toxic").cast(pa.int32()), pa.ListArray.from_arrays(pa.array(cut), pa.array(keys))], names=["toxic", "keys"])

    made = materialize(sample.mapInArrow(lean(run), "toxic int, keys array<long>"), "toxic-keys")
    size = {r["toxic"]: r["count"] for r in made.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Model(chars, np.zeros(0, np.int64), np.zeros(0), 30.0 if n1 else -30.0 if n0 else 0.0)
    by_key = made.select("toxic", F.explode("keys").alias("key")).groupBy("key").agg(F.sum((F.col("toxic") == 1).cast("long")).alias("a"), F.sum((F.col("toxic") == 0).cast("long")).alias("b"))
    a, b = F.col("a"), F.col("b")
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    r1, r0 = n1 / (n1 + n0), n0 / (n1 + n0)
    gain = 2 * (part(a, (a + b) * r1) + part(b, (a + b) * r0) + part(n1 - a, (n1 + n0 - a - b) * r1) + part(n0 - b, (n1 + n0 - a - b) * r0))
    good = by_key.where(a / n1 > b / n0).withColumn("gain", gain).where(F.col("gain") >= least_gain)
    keys = np.sort(np.array([r[0] for r in good.orderBy(F.desc("gain"), "key").limit(most_keys).select("key").collect()], np.int64))
    held = spark.sparkContext.broadcast(keys)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for x in batches:
            lists = x.column("keys")
            flat, rows = lists.flatten().to_numpy(), np.repeat(np.arange(x.num_rows), pc.list_value_length(lists).to_numpy())
            at = np.clip(np.searchsorted(known, flat), 0, max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            cut = np.searchsorted(rows[hit], np.arange(x.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([x.column("toxic"), pa.ListArray.from_arrays(pa.array(cut), pa.array(at[hit].astype(np.int32)))], names=["toxic", "at"])

    rows = made.mapInArrow(lean(found), "toxic int, at array<int>").toArrow().combine_chunks()
    lists = rows.column("at").combine_chunks()
    y = rows.column("toxic").to_numpy().astype(np.float64)
    size = pc.list_value_length(lists).to_numpy().astype(np.int64)
    doc, at = np.repeat(np.arange(len(y)), size), lists.flatten().to_numpy().astype(np.int64)
    del rows, lists
    # The order in which tasks answer must not reach the sums: rows by class and keys.
    sums = np.bincount(doc, weights=(mix(at.astype(np.uint64) + np.uint64(1)) >> np.uint64(12)).astype(np.float64), minlength=len(y))
    order = np.lexsort((sums, size, y))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    back = np.argsort(rank[doc], kind="stable")
    y, doc, at = y[order], rank[doc][back], at[back]
    weights, bias = np.zeros(len(keys)), math.log(n1 / n0)
    seen, seen_b = np.full(len(keys), 1e-6), 1e-6
    heavy = np.where(y == 1, min(3.0, max(1.0, n0 / n1)), 1.0)
    for _ in range(600):
        z = np.bincount(doc, weights=weights[at], minlength=len(y)) + bias
        miss = heavy * (y - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        g = np.bincount(at, weights=miss[doc], minlength=len(keys)) / len(y) - 1e-5 * weights
        gb = miss.mean()
        seen, seen_b = seen + g * g, seen_b + gb * gb
        weights += 0.3 * g / np.sqrt(seen)
        bias += 0.3 * gb / math.sqrt(seen_b)
    give_back()
    return Model(chars, keys, weights, float(bias))


def score(docs: DataFrame, model: Model, keep: Sequence[str], restored: bool = False) -> DataFrame:
    """The columns ``keep`` of docs plus score (0 to 1), predicted and, if asked for, the restored text.

    Whole texts are scored as restored: words that the channel touched count
    as what they were decoded to, each key once per text; words and texts may be of any length. Null
    and empty texts get the score of no evidence. A score of exactly 0.5 is
    predicted 1. Rows are independent and nothing is shuffled: repeated rows get
    equal scores, an empty table gives no rows. Columns of ``keep`` that are
    named as one of the added are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in keep if c.lower() not in ("score", "predicted", "restored")]
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())] + [T.StructField("restored", T.StringType())] * restored
    schema = T.StructType([*[docs.schema[c] for c in names], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        restorer = Restorer(m.chars)
        table_ = np.full(SIZE, -1, np.int32)
        table_[m.keys & (SIZE - 1)] = np.arange(len(m.keys))
        for batch in batches:
            for b in chunked(batch):
                w, wide = split_edges(b.column("text"))
                rows, at = [], []
                stays, more_rows, more = restorer.restored(w, wide)
                for words, where in ((w.distinct, None), (more, more_rows)):
                    if not len(words):
                        continue
                    keys = hashes(words if where is None else pa.array(words, pa.string()))
                    slot = table_[keys & (SIZE - 1)]
                    k, j = np.nonzero(slot >= 0)
                    # Two kept keys may share a slot: the exact place is looked up.
                    exact = np.clip(np.searchsorted(m.keys, keys[k, j]), 0, max(len(m.keys) - 1, 0))
                    good = m.keys[exact] == keys[k, j] if len(k) else np.zeros(0, bool)
                    k, exact = k[good], exact[good]
                    if where is None:
                        per = np.bincount(k, minlength=len(words))
                        start = np.cumsum(per) - per
                        use = np.flatnonzero(stays & (per[w.codes] > 0))
                        codes = w.codes[use]
                        n = per[codes]
                        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                        at.append(exact[np.repeat(start[codes], n) + inner])
                        rows.append(np.repeat(np.searchsorted(w.bounds, use, side="right") - 1, n))
                    else:
                        at.append(exact)
                        rows.append(where[k])
                pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *[r * (len(m.keys) + 1) + a for r, a in zip(rows, at, strict=True)]]))
                r, a = pairs // (len(m.keys) + 1), pairs % (len(m.keys) + 1)
                z = np.bincount(r.astype(np.int64), weights=m.weights[a.astype(np.int64)] if len(a) else None, minlength=b.num_rows) + m.bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                out = [*[b.column(c) for c in names], pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                if restored:
                    out.append(pa.array([t if t is None else restorer.text(t) for t in b.column("text").to_pylist()], pa.string()))
                yield pa.record_batch(out, names=[f.name for f in schema])

    source = docs.select(*dict.fromkeys([*names, "text"]))
    return source.mapInArrow(lean(run), schema)


def held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == rest, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    found = materialize(score(docs, model, ["doc_id"]), "toxicity")
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")
