"""Tokenizing in pieces, packing and token files against the library itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pageloom.llm import packing, rans
from pageloom.llm.tokens import PieceTokenizer, tokenizer_path
from pageloom.session import work_path

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, at int, ids string, part int"


def rows():
    long = " ".join(f"word{i}" for i in range(9000))
    plain = [(i, f"the cat {i} sat.\n On  the mat, don't!", f"s{i % 3}") for i in range(40)]
    odd = [(100, None, None), (101, "", "s1"), (102, long, "s0"), (102, long, "s0"), (None, "no id", "s2"), (103, "a  b\0c", "s1"), (104, " lead  and trail ", None)]
    return [(*r, 1, "x", 2) for r in plain + odd]


def true_ids(path, text):
    return np.array([*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 1], np.uint32)


@pytest.mark.parametrize("name", FILES)
def test_pieces_equal_whole_texts(name, monkeypatch):
    rnd = random.Random(3)
    alphabet = "ab  \n\t.'s1\x1c\x85é漢 Abé!?\r #,;\0"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["<|ENDOFTEXT|> A B", "x <|endoftext|> y"]
    texts += ["".join(rnd.choice(alphabet[:-1]) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    path = tokenizer_path(name)
    monkeypatch.setattr("pageloom.llm.tokens.ROOM", 20_000)  # the cache overflows again and again
    p, t = PieceTokenizer(path, 1), Tokenizer.from_file(path)
    for k in range(0, len(texts), 500):
        part = texts[k : k + 500]
        ids, n = p.encode(pa.array(part))
        ends = np.cumsum(n)
        for text, e, z, m in zip(part, t.encode_batch(part, add_special_tokens=False), ends, n, strict=True):
            assert ids[z - m : z].tolist() == [*e.ids, 1], repr(text)


def test_cache_bears_few_long_pieces(monkeypatch):
    monkeypatch.setattr("pageloom.llm.tokens.ROOM", 4000)
    path = tokenizer_path(FILES[0])
    p = PieceTokenizer(path, 1)
    for k in range(5):
        text = f"x{k}1" * 900 + " the cat"
        ids, n = p.encode(pa.array([text, "the cat"]))
        assert ids[: n[0]].tolist() == true_ids(path, text).tolist() and ids[n[0] :].tolist() == true_ids(path, "the cat").tolist()


def test_packing_holds_every_id_once(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = packing.digest(packing.pack(df, window=256, packet=64)).toPandas()
    path = tokenizer_path(FILES[0])
    expected = sorted((r[0] if r[0] is not None else -1, len(true_ids(path, r[1]))) for r in rows())
    whole = out[out["start"] == 0]
    assert sorted(zip(whole["doc_id"].fillna(-1).astype(int), whole["doc_tokens"], strict=True)) == expected
    assert out["length"].sum() == sum(n for _, n in expected) and (out["length"] > 0).all()
    texts = {r[0]: true_ids(path, r[1]) for r in rows()}
    for r in out.itertuples():
        ids = texts[None if r.doc_id != r.doc_id else int(r.doc_id)][r.start : r.start + r.length]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
    w = out.sort_values(["sequence_id", "offset"])
    fill = w.groupby("sequence_id")["length"]
    assert (w["offset"] == fill.cumsum() - w["length"]).all()
    sizes = fill.sum()
    assert (sizes.iloc[:-1] == 256).all() and sizes.iloc[-1] <= 256 and sizes.index.tolist() == list(range(len(sizes)))


def test_packing_follows_target_shares(spark):
    df = spark.createDataFrame([(i, "word " * 200, f"s{i % 2}") for i in range(60)], "doc_id long, text string, source string")
    out = packing.pack(df, window=256, packet=32, weights={"s0": 3.0, "s1": 1.0}).groupBy("sequence_id").agg(F.sum(F.when(F.col("source") == "s0", F.col("length")).otherwise(0)).alias("s0")).orderBy("sequence_id").toPandas()
    # While both queues last, three quarters of all windows so far are s0's, within a packet.
    both = out["s0"].cumsum().head(20)
    assert ((both - 192 * (both.index + 1)).abs() <= 64).all()


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.digest(packing.pack(df)).count() == 0
    folder = work_path(spark, "none")
    assert rans.read_tokens(rans.write_tokens(df, folder), folder).count() == 0


def test_token_files_round_trip(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    folder = work_path(spark, "rans-test")
    files = rans.write_tokens(df, folder, shard_ids=5000)
    out = rans.read_tokens(files, folder).toPandas()
    path = tokenizer_path(FILES[1])
    want = sorted((-1 if r[0] is None else r[0], true_ids(path, r[1]).astype("<u4").tobytes()) for r in rows())
    got = sorted((-1 if r.doc_id != r.doc_id else int(r.doc_id), bytes(r.ids)) for r in out.itertuples())
    assert got == want
    out["key"] = out["doc_id"].fillna(-1)
    s = out.sort_values(["start"])
    assert s["key"].is_monotonic_increasing and (s["start"] == s["n_tokens"].cumsum() - s["n_tokens"]).all()
    assert (out["ids_crc32"] == [zlib.crc32(bytes(x)) for x in out["ids"]]).all()
    assert files.count() > 2


def test_blocks_segments_and_damage():
    z = np.random.default_rng(1).zipf(1.3, 700_000)
    z = z[z < 40_000].astype(np.uint32)
    t = rans.Table(*np.unique(z, return_counts=True))
    again = rans.Table.from_bytes(t.to_bytes())
    assert t.freq.sum() == 1 << t.bits and again.crc == t.crc
    for n in (1, 2, 63, 1000, len(z)):
        assert (rans.decode_block(rans.encode_block(z[:n], t), again) == z[:n]).all()
    raw = rans.encode_block(z, t)
    size = rans.LANES * rans.SEGMENT
    assert (rans.decode_block(raw, t, 1, 2) == z[size : 2 * size]).all()  # from a checkpoint
    p = np.bincount(z) / len(z)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert len(raw) * 8 / len(z) < 1.1 * entropy + 0.6
    with pytest.raises(ValueError):
        rans.decode_block(raw[:500] + b"\x01\x02" + raw[502:], t)


def test_packing_is_deficit_round_robin(spark):
    """The stream of packets against a queue-by-queue simulation that carries deficits from round to round."""
    rows = [(i, "word " * (37 * i % 90), f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    weights = {"s0": 5.0, "s1": 2.0, "s2": 1.0}
    window, packet = 128, 16
    got = packing.pack(df, window=window, packet=packet, weights=weights).orderBy("sequence_id", "offset").toPandas()
    path = tokenizer_path(FILES[0])
    queues = {s: [] for s in sorted(weights)}
    for i, text, s in rows:
        n = len(true_ids(path, text))
        queues[s] += [(i, k, min(packet, n - k)) for k in range(0, n, packet)]
    deficit, stream = dict.fromkeys(queues, 0.0), []
    while any(queues.values()):
        for s, q in queues.items():
            deficit[s] += window * weights[s] / 8
            while q and q[0][2] <= deficit[s]:
                deficit[s] -= q[0][2]
                stream.append(q.pop(0))
    want = [i for i, _, n in stream for _ in range(n)]
    assert [r.doc_id for r in got.itertuples() for _ in range(r.length)] == want
