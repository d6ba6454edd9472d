"""The ten queries themselves on the smallest tables: against their SQL, or against a plain computation row by row."""

import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pageloom.llm import language, registry, toxicity
from pageloom.llm.tokens import tokenizer_path
from pageloom.llm.words import cut_long, split_words
from pageloom.session import table

SF = "/root/testdata/sf0.001"


def plain(df):
    df = df[sorted(df.columns)].astype(object)
    value = lambda x: None if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x
    return sorted(repr([value(x) for x in row]) for row in df.values.tolist())


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{file}')")
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = con.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) and plain(got) == plain(want)


def forward_backward(emit, moves):
    """Posterior of each word's label, word by word in logarithms."""
    n, k = emit.shape
    log = lambda x: np.log(np.exp(x - x.max()).sum()) + x.max()
    ahead, behind = np.zeros((n, k)), np.zeros((n, k))
    ahead[0] = emit[0]
    for t in range(1, n):
        ahead[t] = [emit[t, j] + log(ahead[t - 1] + moves[:, j]) for j in range(k)]
    for t in range(n - 2, -1, -1):
        behind[t] = [log(moves[j] + emit[t + 1] + behind[t + 1]) for j in range(k)]
    both = ahead + behind
    return np.exp(both - np.array([log(x) for x in both])[:, None])


def test_language_against_plain_forward_backward(spark):
    got = language.op2_language(spark, SF).toPandas().set_index("doc_id")
    docs = table(spark, SF, "documents").toPandas()
    assert len(got) == len(docs) and got.index.is_unique
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    model = language.fit(table(spark, SF, "documents"), ~language.held_out(4, 2))
    for doc, text in list(zip(docs["doc_id"], docs["text"], strict=True))[::7]:
        w = cut_long(split_words(pa.array([text], pa.string()), language.TRIM))
        words = [x for x in (w.distinct[c].as_py() for c in w.codes) if re.search(r"[^\W\d_]", x)]
        if not words:
            assert got.loc[doc, "lang_pred"] == "und" and got.loc[doc, "score"] == 0
            continue
        share = forward_backward(np.concatenate([model.emissions(pa.array([x])) for x in words]).astype(float), model.moves.astype(float)).mean(axis=0)
        assert got.loc[doc, "lang_pred"] == model.labels[share.argmax()] and abs(got.loc[doc, "score"] - share.max()) < 1e-3


def test_toxicity_against_a_sum_over_each_text(spark):
    got = toxicity.op8_toxicity(spark, SF).toPandas().set_index("doc_id")
    docs = table(spark, SF, "documents").toPandas()
    assert len(got) == len(docs) and (got["predicted"] == (got["score"] >= 0.5)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), ~toxicity.held_out(5, 0))
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    for doc, text in list(zip(docs["doc_id"], docs["text"], strict=True))[::5]:
        _, keys = toxicity.text_keys(pa.record_batch([pa.array([text], pa.string())], names=["text"]), toxicity.Restorer(model.chars))
        z = model.bias + sum(weight.get(k, 0.0) for k in set(keys.tolist()))
        assert abs(got.loc[doc, "score"] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-6


def test_token_files_and_packing_hold_the_librarys_ids(spark):
    docs = table(spark, SF, "documents").toPandas().sort_values("doc_id")
    text = docs["text"].fillna("").tolist()
    for name, query in (("word_bpe_49k.json", registry.QUERIES["op5_rans_files"]), ("byte_bpe_50k.json", registry.QUERIES["op4_pack_mixture"])):
        ids = [np.array([*e.ids, 1], "<u4") for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch(text, add_special_tokens=False)]
        got = query(spark, SF).toPandas()
        if "n_tokens" in got:
            got = got.sort_values("doc_id")
            n = np.array([len(x) for x in ids])
            assert got["n_tokens"].tolist() == n.tolist() and got["start"].tolist() == (np.cumsum(n) - n).tolist()
            assert got["ids_crc32"].tolist() == [zlib.crc32(x.tobytes()) for x in ids]
        else:
            of = dict(zip(docs["doc_id"], ids, strict=True))
            assert all(zlib.crc32(of[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got.itertuples())
            assert got.groupby("doc_id")["length"].sum().to_dict() == {d: len(x) for d, x in of.items()}
            assert (got.groupby("sequence_id")["length"].sum().sort_index().iloc[:-1] == 2048).all()


def test_search_finds_what_brute_force_finds(spark):
    got = registry.QUERIES["op6_permutation_search"](spark, SF).toPandas()
    e = table(spark, SF, "embeddings").toPandas()
    x, ids = np.stack(e["embedding"].to_numpy()).astype(float), e["vec_id"].to_numpy()
    hits = 0
    queries = ids[ids % 20 == 0]
    for q in queries:
        s = x @ x[ids == q][0]
        order = np.lexsort((ids, -s))
        want = [int(i) for i in ids[order] if i != q][:20]
        own = got[got["query_id"] == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, len(own) + 1)) and len(own) == len(want)
        hits += len(set(want) & set(own["vec_id"]))
        assert np.allclose(own["score"], [s[ids == v][0] for v in own["vec_id"]])
    assert hits >= 0.9 * 20 * len(queries)


def test_mix_stays_within_its_rules(spark):
    got = registry.QUERIES["op9_mix_sources"](spark, SF).toPandas()
    docs = table(spark, SF, "documents").toPandas()
    size = {d: len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    assert got["size"].tolist() == [size[d] for d in got["doc_id"]] and (got["taken"] <= 2 * got["size"]).all()
    by = got.assign(source=got["doc_id"].map(dict(zip(docs["doc_id"], docs["source"], strict=True))).fillna("")).groupby("source")
    assert (by["size"].sum() == by["source_size"].first()).all()
    assert ((by["taken"].sum() - by["target"].first()).abs() <= by["size"].max()).all()
