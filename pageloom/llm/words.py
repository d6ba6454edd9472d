"""Words of whole texts as codes over distinct words, worked out in Arrow."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of a word that hashes look at; longer words count their length too.
WIDTH = 32
#: Characters of text worked on at once.
CHUNK = 4_000_000
_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A mapInArrow function after which the worker process gives its free memory back.

    Workers live on between tasks; what one stage has freed must not count
    against the next one's executor.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


@dataclass
class Words:
    """bounds[i]..bounds[i+1] are text i's words in codes, which index distinct."""

    bounds: np.ndarray
    codes: np.ndarray
    distinct: pa.StringArray


def split_words(texts: pa.Array, trim: str) -> Words:
    """White-space words in lower case, ``trim`` characters taken off their ends; null is an empty text."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    plain = pc.utf8_trim(pc.utf8_lower(flat.dictionary), characters=trim).dictionary_encode()
    codes = plain.indices.to_numpy().astype(np.int64)[flat.indices.to_numpy()]
    return Words(bounds - bounds[0], codes, plain.dictionary)


def cut_long(w: Words, width: int = WIDTH, shared: int = 3) -> Words:
    """Words of more than ``width`` characters as pieces of at most so many, each with the last ``shared`` of the one before."""
    n = pc.utf8_length(w.distinct).to_numpy().astype(np.int64)
    long = np.flatnonzero(n > width)
    if not len(long):
        return w
    made: list[str] = []
    parts = np.ones(len(n), np.int64)
    for k in long.tolist():
        word = w.distinct[k].as_py()
        pieces = [word[at : at + width] for at in range(0, len(word) - shared, width - shared)]
        parts[k] = len(pieces)
        made += pieces
    first = np.cumsum(parts) - parts
    whole = np.flatnonzero(parts == 1)
    at = np.zeros(int(parts.sum()), np.int64)
    split = np.repeat(parts > 1, parts)
    at[split] = len(whole) + np.arange(len(made))
    at[~split] = np.arange(len(whole))
    every = pa.concat_arrays([w.distinct.take(pa.array(whole)).cast(pa.string()), pa.array(made, pa.string())]).dictionary_encode()
    at = every.indices.to_numpy().astype(np.int64)[at]
    uses = parts[w.codes]
    stop = np.cumsum(uses)
    codes = at[np.repeat(first[w.codes] - (stop - uses), uses) + np.arange(int(uses.sum()))]
    return Words(np.concatenate([[0], stop])[w.bounds], codes, every.dictionary)


def letters(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(code points [n, WIDTH], padded with 0; lengths)."""
    n = pc.utf8_length(words).to_numpy().astype(np.int64)
    if not len(words):
        return np.zeros((0, WIDTH), np.uint32), n
    return np.array(words.to_pylist(), dtype=f"U{WIDTH}").view(np.uint32).reshape(len(words), WIDTH), n


def points(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, one after the other, whole; lengths)."""
    n = pc.utf8_length(words).to_numpy().astype(np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32), n


def sliced(work: Callable[[pa.StringArray], np.ndarray], words: pa.StringArray, step: int = 50_000) -> np.ndarray:
    """``work`` of all words, ``step`` words at a time: its inner tables stay small."""
    return np.concatenate([work(words.slice(k, step)) for k in range(0, max(len(words), 1), step)])


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def prefix_hashes(points: np.ndarray) -> np.ndarray:
    """Column k: a sum over the first k + 1 characters, to be salted and mixed."""
    return np.cumsum(points.astype(np.uint64) * _MULTIPLIERS, axis=1, dtype=np.uint64)


def chunked(batch: pa.RecordBatch, most: int = CHUNK, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``most`` bytes of text or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy()
    first, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > first and total + size > most:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size
    if batch.num_rows > first:
        yield batch.slice(first)
