"""Text functions as Column builders: cleaning, tokens, slices, distances, path parts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions import distance

#: Characters that cleaning deletes, white space in Java's regular expressions.
PUNCTUATION = "!()-[]{};:'\"\\,<>./?@#$%^&*_~"
SPACE = r"(?U)[\s\x1c-\x1f]+"


def remove_tags(s: Column) -> Column:
    """Drops plain lower-case tags; tags with attributes or digits stay."""
    return F.regexp_replace(F.regexp_replace(s, "<[a-z]*>", ""), "</[a-z]*>", "")


def remove_headers(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("<h1>"), F.lit("")), F.lit("</h1>"), F.lit(""))


def remove_punctuation(s: Column) -> Column:
    """Deletes ASCII punctuation but + = | and the backtick; a hyphen's words become one."""
    return F.translate(s, PUNCTUATION, "")


def remove_line_separators(s: Column) -> Column:
    """Deletes line ends and puts nothing in their place."""
    return F.translate(s, "\r\n", "")


def remove_unknown(s: Column) -> Column:
    return F.replace(s, F.lit("[?]"), F.lit(""))


def dash_to_space(s: Column) -> Column:
    return F.translate(s, "\u2014", " ")


def tokens(s: Column) -> Column:
    """Words between runs of Unicode white space; an empty text has none."""
    return F.filter(F.split(s, SPACE), lambda w: w != "")


def collapse_space(s: Column) -> Column:
    return F.array_join(tokens(s), " ")


def clean(s: Column) -> Column:
    """Lower case, tags, headers, punctuation, line ends, unknown marks, dashes, white space, in this order."""
    for step in (F.lower, remove_tags, remove_headers, remove_punctuation, remove_line_separators, remove_unknown, dash_to_space, collapse_space):
        s = step(s)
    return s


def tags(s: Column) -> Column:
    """Distinct plain opening tags, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(s, F.lit("(<[a-z]*>)"), F.lit(1))))


def py_slice(items: Column, start: Column, stop: Column) -> Column:
    """items[start:stop] with Python's rules: negative places count from the end, nothing raises."""
    n = F.size(items)
    lo = F.when(start < 0, F.greatest(n + start, F.lit(0))).otherwise(F.least(start, n))
    hi = F.when(stop < 0, F.greatest(n + stop, F.lit(0))).otherwise(F.least(stop, n))
    return F.slice(items, (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))


def closest(items: Column, target: Column) -> Column:
    """The item nearest to target; the first of equally near ones; null if there is none."""
    return F.array_min(F.transform(items, lambda v, i: F.struct(F.abs(v - target).alias("d"), i.alias("i"), v.alias("v")))).getField("v")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once even where a lambda uses it."""
    return F.transform(F.array(value), body)[0]


def _both(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Which pairs have both sides."""
    return np.flatnonzero(pc.and_(a.is_valid(), b.is_valid()).to_numpy(zero_copy_only=False))


def _codes(texts: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return distance.codes(texts.take(pa.array(rows)).to_pylist())


def _filled(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """values at rows of n, null elsewhere."""
    out, lost = np.zeros(n, values.dtype), np.ones(n, bool)
    out[rows], lost[rows] = values, False
    return pa.array(out, kind, mask=lost)


@F.arrow_udf(T.IntegerType())
def text_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Levenshtein distance in code points; null where a side is.

    Spark's own one works cell by cell; here a batch's pairs go side by side, 64 cells in a step.
    """
    rows = _both(a, b)
    return _filled(distance.distances(_codes(a, rows), _codes(b, rows)), rows, len(a), pa.int32())


@F.arrow_udf(T.IntegerType())
def word_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Levenshtein distance between two word lists; null where one is."""
    rows = _both(a, b)
    sides = [x.take(pa.array(rows)) for x in (a, b)]
    words = pa.concat_arrays([x.flatten() for x in sides]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = [x.value_lengths().to_numpy(zero_copy_only=False) for x in sides]
    cut = int(sizes[0].sum())
    return _filled(distance.distances((words[:cut], sizes[0]), (words[cut:], sizes[1])), rows, len(a), pa.int32())


def word_error_rate(truth: Column, guess: Column) -> Column:
    """Word distance over the number of true words; null if there is none."""
    t = tokens(truth)
    return F.try_divide(word_distance(t, tokens(guess)), F.size(t))


@F.arrow_udf(T.DoubleType())
def match_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """2 * matches / total length over an alignment of characters of fewest edits, then most matches (no native form); 1 for two empty texts."""
    rows = _both(a, b)
    x, y = _codes(a, rows), _codes(b, rows)
    total = x[1] + y[1]
    return _filled(np.where(total > 0, 2.0 * distance.matches(x, y) / np.maximum(total, 1), 1.0), rows, len(a), pa.float64())


#: Error metrics by name, of (truth, guess) as clean strings.
ERROR_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "wer": word_error_rate,
    "editdistance": lambda t, g: text_distance(t, g).cast("double"),
    "lev": lambda t, g: text_distance(t, g).cast("double"),
    "edit_distance": match_ratio,
}


def last_parts(path: Column, k: int) -> Column:
    """The last k parts of a path, fewer if it has fewer."""
    parts = F.split(path, "/")
    return F.slice(parts, -F.least(F.size(parts), F.lit(k)), F.least(F.size(parts), F.lit(k)))


def file_stem(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.element_at(F.split(F.element_at(F.split(path, "/"), -1), r"\."), 1)


def suffix_key(path: Column) -> Column:
    """What follows the last underscore of the stem."""
    return F.element_at(F.split(file_stem(path), "_"), -1)


def zero_pad(n: Column, width: int = 3) -> Column:
    """Digits padded on the left; longer numbers stay whole."""
    s = n.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def wrap(words: Column, every: int) -> Column:
    """Words joined by blanks, a line end after each word whose place is a positive multiple of ``every``."""
    return F.array_join(F.transform(words, lambda w, i: F.when((i % every == 0) & (i > 0), F.concat(w, F.lit("\n"))).otherwise(w)), " ")


def keep_key(path: Column, suffix: str, keyword: str = "", level: int | None = None) -> Column:
    """Whether a key ends with suffix, holds keyword and lies ``level`` folders deep (0 counts)."""
    ok = path.endswith(suffix) & path.contains(keyword)
    return ok if level is None else ok & (F.size(F.split(path, "/")) == level + 1)
