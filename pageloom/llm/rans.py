"""Token files: static range asymmetric numeral system with interleaved lanes.

A folder holds one frequency table for all files (``table.rans``) and files
``ids-<first id, 16 digits>.rans``; their name order is document order.

    table:  b"PLRT", u32 scale bits, u32 n, u32 symbols[n], u32 frequencies[n]
    file:   b"PLRF", u32 table crc32, u32 n_blocks, u32 n_docs, u64 start
            n_blocks times (u64 offset, u64 size, u64 n_ids)
            n_docs doc ids (i64), n_docs lengths (i64), n_docs null marks (u8)
            u32 crc32 of all that, then the blocks
    block:  u32 crc32 of what follows it, u32 n_ids, u32 lanes, u32 n_points, u32 n_words
            n_points + 1 times u32 crc32 of the ids of a segment
            n_points times u32 words read before it
            n_points + 1 times u64 states[lanes], then u32 words[n_words]

Lane j codes ids j, j + lanes, ... A block needs nothing but the table; a
checkpoint every SEGMENT steps holds the decoder's states, so segments can be
decoded in parallel, and each has its own checksum. All little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.tokens import bytes_of, tokenize, tokenizer_path, vocabulary_size
from pageloom.llm.words import lean
from pageloom.session import materialize, table, work_path

END_ID = 1
LOW = np.uint64(1 << 31)
LANES, SEGMENT, BLOCK, SHARD = 2048, 128, 1 << 20, 1 << 22
_U32 = np.uint64(32)


class Table:
    """Frequencies of symbols that add up to 2 ** bits, each at least 1."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray, bits: int | None = None):
        order = np.argsort(symbols, kind="stable")
        self.symbols, counts = np.asarray(symbols, np.uint32)[order], np.asarray(counts, np.float64)[order]
        n = len(self.symbols)
        self.bits = bits or max(12, min(20, int(np.ceil(np.log2(max(n, 1)))) + 4))
        whole = 1 << self.bits
        if n > whole:
            raise ValueError("more symbols than the scale can tell apart")
        freq = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (whole - n)).astype(np.int64) + 1) if n else np.zeros(0, np.int64)
        if n:
            freq[np.argmax(freq)] += whole - freq.sum()
        self._derive(freq)

    def _derive(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.rank = np.zeros(int(self.symbols.max()) + 1 if len(freq) else 0, np.int64)
        self.rank[self.symbols] = np.arange(len(freq))
        self.crc = zlib.crc32(self.to_bytes())

    def to_bytes(self) -> bytes:
        return b"PLRT" + struct.pack("<II", self.bits, len(self.symbols)) + self.symbols.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        if raw[:4] != b"PLRT":
            raise ValueError("no frequency table")
        self = cls.__new__(cls)
        self.bits, n = struct.unpack_from("<II", raw, 4)
        self.symbols = np.frombuffer(raw, "<u4", n, 12)
        self._derive(np.frombuffer(raw, "<u4", n, 12 + 4 * n))
        return self


def encode_block(ids: np.ndarray, t: Table) -> bytes:
    n = len(ids)
    lanes = int(max(1, min(LANES, n // 64)))
    steps = -(-n // lanes)
    rank = t.rank[ids]
    freq, cum, bits = t.freq[rank], t.cum[rank], np.uint64(t.bits)
    x = np.full(lanes, LOW, np.uint64)
    out: list[np.ndarray] = []
    points: list[tuple[int, np.ndarray]] = []
    room = np.uint64(63 - t.bits)
    for s in range(steps - 1, -1, -1):
        at = slice(s * lanes, min(n, (s + 1) * lanes))
        f, c = freq[at], cum[at]
        live = x[: len(f)]
        over = live >= (f << room)
        if over.any():
            out.append((live[over] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            live[over] >>= _U32
        q = live // f
        live[:] = (q << bits) + (live - q * f) + c
        if s and s % SEGMENT == 0:
            points.append((sum(map(len, out)), x.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    points.reverse()
    size = lanes * SEGMENT
    sums = [zlib.crc32(ids[k : k + size].astype("<u4").tobytes()) for k in range(0, n, size)]
    body = struct.pack("<IIII", n, lanes, len(points), len(words)) + np.array(sums, "<u4").tobytes()
    body += np.array([len(words) - p for p, _ in points], "<u4").tobytes()
    body += np.concatenate([x, *[s for _, s in points]]).astype("<u8").tobytes() + words.astype("<u4").tobytes()
    return struct.pack("<I", zlib.crc32(body)) + body


def decode_block(raw: bytes, t: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the block's segments first..last-1 (all by default); ValueError on damage."""
    if zlib.crc32(memoryview(raw)[4:]) != struct.unpack_from("<I", raw)[0]:
        raise ValueError("damaged block")
    n, lanes, n_points, n_words = struct.unpack_from("<IIII", raw, 4)
    segments = n_points + 1
    last = segments if last is None else min(last, segments)
    at = 20
    sums = np.frombuffer(raw, "<u4", segments, at)
    at += 4 * segments
    starts = np.concatenate([[0], np.frombuffer(raw, "<u4", n_points, at)]).astype(np.int64)
    at += 4 * n_points
    states = np.frombuffer(raw, "<u8", segments * lanes, at).reshape(segments, lanes)
    words = np.frombuffer(raw, "<u4", n_words, at + 8 * segments * lanes)
    mask, bits = np.uint64((1 << t.bits) - 1), np.uint64(t.bits)
    found = []
    for g in range(first, last):
        x, pos = states[g].astype(np.uint64), int(starts[g])
        lo, hi = g * SEGMENT * lanes, min(n, (g + 1) * SEGMENT * lanes)
        ids = np.empty(hi - lo, np.uint32)
        for k in range(0, hi - lo, lanes):
            live = x[: min(lanes, hi - lo - k)]
            slot = live & mask
            r = t.slots[slot.astype(np.int64)]
            ids[k : k + len(live)] = r
            live[:] = t.freq[r] * (live >> bits) + slot - t.cum[r]
            low = live < LOW
            count = int(np.count_nonzero(low))
            if count:
                live[low] = (live[low] << _U32) | words[pos : pos + count].astype(np.uint64)
                pos += count
        ids = t.symbols[ids]
        if zlib.crc32(ids.astype("<u4").tobytes()) != sums[g]:
            raise ValueError("damaged segment")
        found.append(ids)
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def encode_file(docs: list[int | None], lengths: np.ndarray, ids: np.ndarray, start: int, t: Table) -> bytes:
    blocks = [encode_block(ids[k : k + BLOCK], t) for k in range(0, len(ids), BLOCK)]
    sizes = np.array([len(b) for b in blocks], np.int64)
    index = np.stack([np.cumsum(sizes) - sizes, sizes, [min(BLOCK, len(ids) - k) for k in range(0, len(ids), BLOCK)]], axis=1) if blocks else np.zeros((0, 3), np.int64)
    head = b"PLRF" + struct.pack("<IIIQ", t.crc, len(blocks), len(docs), start) + index.astype("<u8").tobytes()
    head += np.array([d or 0 for d in docs], "<i8").tobytes() + np.asarray(lengths, "<i8").tobytes() + np.array([d is None for d in docs], "u1").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def decode_file(raw: bytes, t: Table) -> tuple[list[int | None], np.ndarray, int, Iterator[np.ndarray]]:
    """(doc ids, lengths, ids before the file, its blocks' ids one by one)."""
    crc, n_blocks, n_docs, start = struct.unpack_from("<IIIQ", raw, 4)
    size = 24 + 24 * n_blocks + 17 * n_docs
    if raw[:4] != b"PLRF" or zlib.crc32(memoryview(raw)[:size]) != struct.unpack_from("<I", raw, size)[0]:
        raise ValueError("damaged file head")
    if crc != t.crc:
        raise ValueError("the file was written with another table")
    index = np.frombuffer(raw, "<u8", 3 * n_blocks, 24).reshape(-1, 3).astype(np.int64)
    at = 24 + 24 * n_blocks
    keys, lengths = np.frombuffer(raw, "<i8", n_docs, at), np.frombuffer(raw, "<i8", n_docs, at + 8 * n_docs)
    null = np.frombuffer(raw, "u1", n_docs, at + 16 * n_docs)
    body = size + 4
    blocks = (decode_block(raw[body + o : body + o + s], t) for o, s, _ in index)
    return [None if z else int(k) for k, z in zip(keys, null, strict=True)], lengths, start, blocks


def _qualified(spark: SparkSession, folder: str) -> str:
    """A folder as a URI with its scheme: one without is what Hadoop's default file system holds, not a machine's own disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()


def _store(uri: str):  # noqa: ANN202
    """(file system, path) of a folder that all executors share; a scheme that Arrow does not know raises."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")


def _put(uri: str, name: str, raw: bytes) -> None:
    """Write under a name of this attempt, then rename: a task that runs again or twice leaves one whole file."""
    store, path = _store(uri)
    store.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(raw)
    store.move(own, f"{path}/{name}")


def _get(uri: str, name: str) -> bytes:
    store, path = _store(uri)
    with store.open_input_stream(f"{path}/{name}") as f:
        return f.read()


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, shard_ids: int = SHARD) -> DataFrame:
    """Encode docs(doc_id, text) into ``folder``; returns (file, start, n_ids, n_docs) per file.

    Rows are range-partitioned and sorted by doc_id (null first, equal ids by
    text) and tokenised once into a work table, with each partition's counts
    of ids; their sum, at most one row per vocabulary entry, is what the
    driver sees, with one sum per partition. Each task then cuts its sorted runs into files of
    about ``shard_ids`` ids and whole documents; a longer document is a file
    of several blocks. Names and contents depend only on the work table, so a
    rerun task replaces its files by equal ones. Null text is empty: one end
    id. Repeated rows are separate documents; a null doc_id is kept as such. No rows: no files but the table. Columns other than
    doc_id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    folder = _qualified(spark, folder)
    path = path or tokenizer_path("word_bpe_49k.json")
    wide = vocabulary_size(path)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    d = d.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    both = materialize(tokenize(d, path, END_ID, F.lit(""), 2 if wide <= 1 << 16 else 4, wide), "rans-ids")
    made = both.where("seq >= 0")
    kind = "<u2" if wide <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(wide, np.int64)
        for b in batches:
            seen += np.frombuffer(bytes_of(b.column("ids")), "<u8").astype(np.int64).reshape(-1, wide).sum(axis=0)
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(at), pa.array(seen[at])], names=["id", "n"])

    counts = both.where("seq = -1").select("ids").mapInArrow(lean(count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    t = Table(counts["id"].to_numpy(np.uint32), counts["n"].to_numpy(np.int64))
    raw_table = t.to_bytes()
    _put(folder, "table.rans", raw_table)
    base, before = {}, 0
    for part, n in made.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base[part] = before
        before += n
    shared = spark.sparkContext.broadcast((raw_table, base))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, bases = shared.value
        coder = Table.from_bytes(raw)
        docs_, ids, last, start, size = [], [], None, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal docs_, ids, size
            if docs_:
                name = f"ids-{start:016d}.rans"
                _put(folder, name, encode_file(docs_, np.array([len(x) for x in ids]), np.concatenate(ids), start, coder))
                yield pa.record_batch([pa.array([name]), pa.array([start]), pa.array([size]), pa.array([len(docs_)])], names=["file", "start", "n_ids", "n_docs"])
            docs_, ids, size = [], [], 0

        for b in batches:
            for doc, part, seq, at, n, x in zip(*[b.column(c) if c == "ids" else b.column(c).to_pylist() for c in ("doc_id", "part", "seq", "at", "n", "ids")], strict=True):
                if (part, seq - 1) != last or size and size + n > shard_ids:
                    yield from flush()
                    start = bases[part] + at
                last = (part, seq)
                docs_.append(doc)
                ids.append(np.frombuffer(x.as_buffer(), kind))
                size += n
        yield from flush()

    return materialize(made.drop("grp").mapInArrow(lean(write), "file string, start long, n_ids long, n_docs long"), "rans-files")


def read_tokens(files: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and (if asked for) ids, as little-endian uint32, of every document in the files.

    A task decodes file after file and block after block; the files are dealt
    out evenly. Any damage raises.
    """
    folder = _qualified(files.sparkSession, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for b in batches:
            for name in b.column("file").to_pylist():
                coder = coder or Table.from_bytes(_get(folder, "table.rans"))
                docs, lengths, start, blocks = decode_file(_get(folder, name), coder)
                ids = np.concatenate([np.zeros(0, np.uint32), *blocks]).astype("<u4")
                ends = np.cumsum(lengths)
                for k in range(0, len(docs), 1000):
                    n, e = lengths[k : k + 1000], ends[k : k + 1000]
                    lo = int(e[0] - n[0])
                    raw, cut = memoryview(ids[lo : e[-1]].tobytes()), np.concatenate([[0], 4 * (e - lo)])
                    crc = [zlib.crc32(raw[a:z]) for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                    out = [pa.array(docs[k : k + 1000], pa.int64()), pa.array(start + e - n), pa.array(n), pa.array(crc, pa.int64())]
                    if with_ids:
                        out.append(pa.Array.from_buffers(pa.binary(), len(n), [None, pa.array(cut.astype(np.int32)).buffers()[1], pa.py_buffer(raw)]))
                    yield pa.record_batch(out, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])

    n = max(1, min(files.count(), 100_000))
    return files.select("file").repartition(n).mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op5_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "rans")
    files = write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(files, folder, with_ids=False)
