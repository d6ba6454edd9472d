"""Whole texts to token ids with a public tokenizer file, word by word."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.words import chunked, lean

#: A text is cut before a blank, tab or line end that follows anything but
#: white space, and between a Latin letter and the punctuation marks below.
#: There every supported pre-tokenizer has a boundary, so pieces can be encoded
#: alone. Rarer white space stays inside a piece.
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
#: Texts are joined by NUL, which is a piece of its own.
PIECE = re.compile(rf"[ \n]?{_LETTER}+(?=[.,;:!?*#%$&\0]|[ \n]{_LETTER})|\s*[^\s\0]+(?:(?=[^\S \n\r\t])\s+[^\s\0]*)*|\s+|\0")
#: Words of such letters alone are one pre-token, so the file's model can have them directly.
_WORD = rf"^ ?{_LETTER}+$"
#: Bytes of text encoded at once (the more, the fewer words are met again), and bytes that a worker's cache may hold.
CHUNK, ROOM = 8_000_000, 64 << 20
#: A blank after white space, or at the start: such a text is not cut at every blank.
_ODD = r"^ |[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


class WordCache:
    """Ids of words, in Arrow and NumPy alone: no Python object is held, and ``nbytes`` counts all of it."""

    def __init__(self, room: int):
        self.room = room
        self._set(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _set(self, words: pa.StringArray, count: np.ndarray, ids: np.ndarray, uses: np.ndarray) -> None:
        self.words, self.count, self.ids, self.uses = words, count, ids, uses

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.count.nbytes + self.ids.nbytes + self.uses.nbytes

    def find(self, words: pa.StringArray) -> np.ndarray:
        """The place of each word, -1 where it is not held."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)

    def add(self, words: pa.StringArray, count: np.ndarray, ids: np.ndarray) -> int:
        """Holds more words; gives the place of their first."""
        known = len(self.count)
        self._set(pa.concat_arrays([self.words, words]), np.append(self.count, count.astype(np.int32)), np.append(self.ids, ids), np.append(self.uses, np.zeros(len(words), np.int64)))
        return known

    def shrink(self) -> None:
        """If there is more than the room, keep what was used most for its size, in half of the room; no more than that is ever left."""
        if self.nbytes <= self.room:
            return
        size = pc.binary_length(self.words).to_numpy() + 4 * self.count.astype(np.int64) + 16
        order = np.lexsort((size, -self.uses))
        order = order[self.uses[order] > 1]
        keep = np.sort(order[np.cumsum(size[order]) <= self.room // 2])
        _, ids = gathered(self.count, self.ids, keep)
        self._set(pa.concat_arrays([self.words.take(pa.array(keep))]), self.count[keep], ids, self.uses[keep] // 2)


def gathered(count: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids up to and with each entry of ``at``, their ids), entry k being count[k] ids in a row."""
    kind = np.int32 if len(ids) < 1 << 30 else np.int64
    first = (np.cumsum(count, dtype=np.int64) - count).astype(kind)
    n = count[at]
    stop = np.cumsum(n, dtype=np.int64)
    if len(stop) and stop[-1] >= 1 << 31:
        kind, first = np.int64, first.astype(np.int64)
    where = np.repeat(first[at] - (stop - n).astype(kind), n)
    where += np.arange(len(where), dtype=kind)
    return stop, ids[where]


class PieceTokenizer:
    """Encodes each new word once and gathers the rest from a bounded cache.

    A file is tried when it is loaded: texts put together from a few hundred
    pieces must give the ids that the library gives for the whole texts. If
    they do not, its pre-tokenizer has other boundaries than those used here,
    and whole texts go through the library. Likewise words of letters go
    to the file's model directly only if that gives the library's ids.
    """

    _of_process: dict[tuple[str, int], PieceTokenizer] = {}

    @classmethod
    def shared(cls, path: str, end_id: int, room: int | None = None) -> PieceTokenizer:
        """The one of this worker process, so that a later task finds the cache warm; ``room`` holds from now on."""
        if (path, end_id) not in cls._of_process:
            cls._of_process[path, end_id] = cls(path, end_id, room)
        found = cls._of_process[path, end_id]
        found._give(room)
        return found

    def __init__(self, path: str, end_id: int, room: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        # Words as they stand behind a blank, and the pieces of new words: many words are a piece and some marks.
        self.words, self.pieces = WordCache(0), WordCache(0)
        self._give(room)
        # Where the file's own normalizer lowers case, doing so first makes fewer words distinct.
        self.lower = '"type":"Lowercase"' in self.tokenizer.to_str()
        self.direct = self.whole = False
        self._try()

    def _give(self, room: int | None) -> None:
        room = room or ROOM
        self.words.room, self.pieces.room = room * 2 // 3, room // 3

    def _try(self) -> None:
        rnd = random.Random(7)
        letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
        words = [" " * (k % 2) + "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for k in range(200)]
        words += ["".join(letters[k : k + 12]) for k in range(0, len(letters), 12)]
        try:
            self._plain(letters)
            n, ids = self._by_model(words)
            true = self._library(words)
            self.direct = n.tolist() == list(map(len, true)) and ids.tolist() == list(chain.from_iterable(true))
        except Exception:  # noqa: BLE001 (a model or pre-tokenizer of another kind: the library's way is taken)
            self.direct = False
        parts = [" ", "  ", "\n", "\t", "\r\n", ".", ", ", "'s", "!?", "###", "12", "\u3000", "\u0301", "\u6f22", "-", "(", *words[:30]]
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25))) for _ in range(200)]
        ids, n = self.encode(pa.array(texts))
        self.whole = ids.tolist() != [i for x in self._library(texts) for i in (*x, self.end_id)]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, letters: list[str]) -> None:
        """The file's model behind no more than a split at line ends, and what its normalizer and byte level make of letters."""
        from tokenizers import Tokenizer, pre_tokenizers

        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        ((self.before, _),) = self.tokenizer.pre_tokenizer.pre_tokenize_str(" a")
        self.before = self.before[:-1]  # what a blank before a word becomes
        table = [(c, level.pre_tokenize_str(normal(c))[0][0]) for c in letters if not c.isascii()]
        # Letters that others turn into come first: no letter is turned twice.
        self.table = sorted(table, key=lambda x: not any(x[0] in mapped for _, mapped in table))
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        (self.mark,) = self.plain.encode("!", add_special_tokens=False).ids

    def _by_model(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters: they cannot hold the mark that stands after each."""
        text = "\n!\n".join([*words, ""])
        text = (text.lower() if self.lower else text).replace(" ", self.before)
        if not text.isascii():
            for c, mapped in self.table:
                text = text.replace(c, mapped)
        (found,) = self.plain.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(words):
            raise ValueError("a word of letters holds the mark")
        return np.diff(ends, prepend=-1).astype(np.int32) - 1, ids[ids != self.mark]

    def _learn(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, ids of all)."""
        easy = pc.match_substring_regex(pieces, _WORD).to_numpy(zero_copy_only=False) & self.direct
        order = np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)])
        words, others = pieces.filter(pa.array(easy)), pieces.filter(pa.array(~easy))
        counts, ids = [np.zeros(0, np.int32)], [np.zeros(0, np.uint32)]
        for k in range(0, len(words), 8192):
            n, x = self._by_model(words.slice(k, 8192).to_pylist())
            counts.append(n)
            ids.append(x)
        for k in range(0, len(others), 8192):
            found = self._library(others.slice(k, 8192).to_pylist())
            counts.append(np.fromiter(map(len, found), np.int32, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        count = np.concatenate(counts)
        return count[at], gathered(count, np.concatenate(ids), at)[1]

    def _segments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all), each piece that is not known encoded once."""
        pieces = pa.array(PIECE.findall("\0".join([*texts, ""])), pa.string()).dictionary_encode()
        names, at = pieces.dictionary, pieces.indices.to_numpy()
        end = pc.index(names, "\0").as_py()
        place = self.pieces.find(names)
        uses = np.bincount(at, minlength=len(names))
        new = np.flatnonzero((place < 0) & (np.arange(len(names)) != end))
        fresh = names.take(pa.array(new))
        known = self.pieces.add(fresh, *self._learn(fresh))
        place[new] = known + np.arange(len(new))
        place[end] = len(self.pieces.count)
        count, ids = np.append(self.pieces.count, np.int32(0)), self.pieces.ids
        inner = place != len(self.pieces.count)
        self.pieces.uses[place[inner]] += uses[inner]
        self.pieces.shrink()
        stop, ids = gathered(count, ids, place[at])
        return np.diff(stop[at == end], prepend=0), ids

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each), the end id after each text.

        Texts are cut at single blanks and equal words met once per call; the
        few texts where a blank follows white space are cut by PIECE alone,
        those with NUL not at all.
        """
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.whole or pc.any(pc.match_substring(texts, "\0")).as_py():
            found = [np.array([*ids, self.end_id], np.uint32) for k in range(0, len(texts), 256) for ids in self._library(texts.slice(k, 256).to_pylist())]
            return np.concatenate(found), np.array([len(f) for f in found], np.int64)
        if self.lower and not pc.any(pc.match_substring(texts, "<|")).as_py():  # no upper-case look-alike of a special token
            texts = pc.ascii_lower(texts)
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        whole = texts.filter(pa.array(odd)).to_pylist()
        words = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        flat = words.flatten().dictionary_encode()
        bounds = words.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        del words
        distinct, place = flat.dictionary, flat.indices.to_numpy()
        head = np.zeros(len(place), bool)
        head[bounds[:-1]] = True
        # Words behind a blank: from the cache, or new. Those that only begin texts are not wanted.
        uses = np.bincount(place[~head], minlength=len(distinct))
        held = self.words.find(distinct)
        new = np.flatnonzero((held < 0) & (uses > 0))
        heads, of_head = np.unique(place[head], return_inverse=True)
        behind = distinct.take(pa.array(new))
        n, ids = self._segments([*(" " + w for w in behind.to_pylist()), *distinct.take(pa.array(heads)).to_pylist(), *whole])
        known = len(self.words.count)
        # Entries: the cache's words, the new segments, the end id. Every text is a run of entries closed by the end.
        count = np.concatenate([self.words.count, n.astype(np.int32), np.ones(1, np.int32)])
        every = np.concatenate([self.words.ids, ids, np.array([self.end_id], np.uint32)])
        self.words.uses += np.bincount(held[held >= 0], weights=uses[held >= 0], minlength=known).astype(np.int64)
        self.words.add(behind, n[: len(new)], ids[: int(n[: len(new)].sum())])
        self.words.uses[known:] += uses[new]
        self.words.shrink()
        held[new] = known + np.arange(len(new))
        entry = held.astype(np.int32)[place]
        entry[head] = known + len(new) + of_head
        size = np.ones(len(texts), np.int64)
        size[~odd] = np.diff(bounds)
        stops = np.cumsum(size + 1)
        at = np.full(int(stops[-1]), len(count) - 1, np.int32)
        own = np.ones(len(at), bool)
        own[stops - 1] = False
        of_odd = np.repeat(odd, size)
        entries = np.empty(len(of_odd), np.int32)
        entries[~of_odd] = entry
        entries[of_odd] = known + len(new) + len(heads) + np.arange(len(whole))
        at[own] = entries
        ends, found = gathered(count, every, at)
        return found, np.diff(ends[stops - 1], prepend=0)


def bytes_of(column: pa.BinaryArray) -> memoryview:
    """All values of a binary column without nulls, one after the other."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return memoryview(column.buffers()[2])[int(ends[0]) : int(ends[-1])] if len(column) else memoryview(b"")


def ids_to_crc32(df: DataFrame, width: int) -> DataFrame:
    """Column ids (``width`` bytes each) replaced by ids_crc32, the checksum of the ids as little-endian uint32."""
    names = [c for c in df.columns if c != "ids"]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            raw = memoryview(np.frombuffer(bytes_of(ids), f"<u{width}").astype("<u4").tobytes())
            cut = np.cumsum(np.concatenate([[0], pc.binary_length(ids).to_numpy().astype(np.int64) * 4 // width])).tolist()
            crc = [zlib.crc32(raw[a:z]) for a, z in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.record_batch([*[b.column(c) for c in names], pa.array(crc, pa.int64())], names=schema.names)

    return df.mapInArrow(lean(run), schema)


def tokenize(docs: DataFrame, path: str, end_id: int, group: Column, width: int = 4, vocabulary: int = 0, room: int = ROOM) -> DataFrame:
    """doc_id, grp, part, seq, at, n, ids of every row of docs(doc_id, text).

    ids: the text's ids and end_id, little-endian, ``width`` bytes each. part is the task's
    partition, seq the row's place in it, at the ids before it of the same
    grp (a string) within the partition. These numbers hold once the result is
    written; a partition's rows keep their order. With ``vocabulary``, each
    partition ends in a row with seq -1, whose ids are that many uint64 counts.
    ``room`` bounds the cache of a worker process, in bytes.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("grp", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, part, seq = PieceTokenizer.shared(path, end_id, room), TaskContext.get().partitionId(), 0
        before: dict[str, int] = {}
        uses = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for b in chunked(batch, CHUNK):
                ids, counts = tokenizer.encode(pc.fill_null(b.column("text"), ""))
                if vocabulary:
                    uses += np.bincount(ids, minlength=vocabulary)
                raw, ends = ids.astype(f"<u{width}").tobytes(), np.cumsum(counts)
                groups = b.column("grp").to_pylist()
                at = []
                for g, n in zip(groups, counts.tolist(), strict=True):
                    at.append(before.get(g, 0))
                    before[g] = at[-1] + n
                offsets = pa.array(np.concatenate([[0], width * ends]).astype(np.int32)).buffers()[1]
                yield pa.record_batch(
                    [
                        b.column("doc_id"), b.column("grp"), pa.array(np.full(b.num_rows, part, np.int32)),
                        pa.array(np.arange(seq, seq + b.num_rows)), pa.array(at, pa.int64()), pa.array(counts),
                        pa.Array.from_buffers(pa.binary(), b.num_rows, [None, offsets, pa.py_buffer(raw)]),
                    ],
                    schema=fields,
                )
                seq += b.num_rows
        if seq and vocabulary:
            last = [None, "", part, -1, 0, 0, uses.astype("<u8").tobytes()]
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip(last, fields, strict=True)], schema=fields)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.alias("grp"), "text")
    return source.mapInArrow(lean(run), "doc_id long, grp string, part int, seq long, at long, n long, ids binary")
