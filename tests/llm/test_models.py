import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pageloom.llm import language, toxicity
from pageloom.llm.words import cut_long, lean, split_words
from pageloom.session import table

SF = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(3)
    scores, moves = rng.standard_normal((7, 3)), rng.standard_normal((3, 3))
    first, length = np.array([0, 4]), np.array([4, 3])
    post, pairs = language.marginals(scores, (first, length, np.zeros(2, np.int64)), moves)
    want, want_pairs = np.zeros((7, 3)), np.zeros((3, 3))
    for lo, n in zip(first, length, strict=True):
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        w = np.exp([sum(scores[lo + t, p[t]] for t in range(n)) + sum(moves[p[t - 1], p[t]] for t in range(1, n)) for p in paths])
        w /= w.sum()
        for p, x in zip(paths, w, strict=True):
            for t in range(n):
                want[lo + t, p[t]] += x
                if t:
                    want_pairs[p[t - 1], p[t]] += x
    assert np.allclose(post, want, atol=1e-5) and np.allclose(pairs, want_pairs, atol=1e-4)


def test_chains_cover_texts():
    first, length, place = language.chains(np.array([0, 0, 5, 5 + 3000, 3005]))
    assert length.max() <= language.CHAIN and length.sum() == 3005 and place.max() == 2999 // language.CHAIN
    assert sorted(np.concatenate([np.arange(a, a + n) for a, n in zip(first, length, strict=True)]).tolist()) == list(range(3005))


def test_blocks_carry_the_chains_state(monkeypatch):
    rng = np.random.default_rng(4)
    bounds = np.array([0, 50, 50, 51, 70, 71, 200])
    scores, moves = 2 * rng.standard_normal((200, 4)), rng.standard_normal((4, 4))
    monkeypatch.setattr(language, "CHAIN", 1000)
    want, want_pairs = language.marginals(scores, language.chains(bounds), moves)
    for size in (1, 2, 7, 19, 64):
        monkeypatch.setattr(language, "CHAIN", size)
        post, pairs = language.marginals(scores, language.chains(bounds), moves)
        assert np.allclose(post, want, atol=1e-4) and np.allclose(pairs, want_pairs, atol=1e-2)


def test_switching_is_learned():
    texts = [" ".join(random.Random(k).choices(["aba", "abo", "bab"] if k % 2 else ["xyx", "yxy", "zyz"], k=90)) for k in range(60)]
    model = language.train(texts, ["a" if k % 2 else "x" for k in range(60)])
    stay, leave = np.diag(model.moves).min(), model.moves[~np.eye(2, dtype=bool)].max()
    assert stay > leave > stay - 12


def test_a_language_in_many_copies_is_learned(spark):
    common = [(k, f"aab bba abab {k % 40} aaa", "aa") for k in range(20_000)]
    rare = [(100_000 + k, f"zyx xyz zzy {k} yyx", "zz") for k in range(100)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert model.labels == ["aa", "zz"]
    assert {r["lang_pred"] for r in language.label(docs.limit(50), model, ["doc_id"]).collect()} == {"aa"}


def test_language_of_held_out_texts(spark):
    docs = table(spark, SF, "documents")
    model = language.fit(docs, ~language.held_out(4, 2))
    out = language.label(docs, model, ["doc_id", "lang"]).where(language.held_out(4, 2)).toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97 and out["score"].between(0, 1).all()
    odd = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (3, "123 !!", "x", 1), (4, "the and " * 50000, "x", 1), (4, "the and " * 50000, "x", 1)], "doc_id long, text string, lang_pred string, score int")
    r = language.label(odd, model, odd.columns).select("doc_id", "lang_pred", "score").orderBy("doc_id").collect()
    assert [(x["lang_pred"], x["score"]) for x in r[:3]] == [("und", 0.0)] * 3 and {x["lang_pred"] for x in r[3:]} == {"en"}
    assert language.label(odd.where("false"), model, ["doc_id"]).count() == 0


def test_code_switched_text_is_labelled_word_by_word(spark):
    docs = table(spark, SF, "documents")
    texts = {x["lang"]: x["t"] for x in docs.where("n_chars > 3000").groupBy("lang").agg(F.max("text").alias("t")).collect()}
    mixed = " ".join([*texts["de"].split()[:300], *texts["fr"].split()[:100]])
    model = language.fit(docs, F.lit(True))
    r = language.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model, ["doc_id"], per_word=True).first()
    assert r["labels"][:250].count("de") > 240 and r["labels"][-80:].count("fr") > 70
    assert r["lang_pred"] == "de" and 0.6 < r["score"] < 0.9


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert language.label(docs, model, ["doc_id"]).first()["lang_pred"] == "und"
    m = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert toxicity.score(docs, m, ["doc_id"]).first()["predicted"] in (0, 1)


def chars(words):
    grams = {}
    for w, n in words.items():
        x = "\0\0" + w + "\0"
        for i in range(len(x) - 2):
            grams[x[i : i + 3]] = grams.get(x[i : i + 3], 0) + n
    return toxicity.CharModel(grams)


def test_viterbi_finds_the_cheapest_reading():
    model = chars({"idiot": 50, "clown": 50, "the": 500, "hello": 100})
    r = toxicity.Restorer(model)
    assert r.text("1d10t") == "idiot" and r.text("c.l.o.w.n") == "clown" and r.text("cl0000wn hello") == "clown hello"
    assert r.text("i d i o t the") == "idiot the"
    assert r.text("hello the 1999") == "hello the 1999"

    def best(word):  # every way through the lattice
        ways = [("", 0.0)]
        for k, c in enumerate(word):
            options = [(c, 0.0)] * c.isalpha() + [(x, toxicity.SUBSTITUTE) for x in toxicity.LEET.get(c, "")]
            options += [("", toxicity.DROP_MARK)] * (c in toxicity.MARKS) + [("", toxicity.DROP_REPEAT)] * (k > 0 and word[k - 1] == c)
            ways = [(t + x, n + e) for t, n in ways for x, e in options]
        cost = lambda t: sum(model.cost(("\0\0" + t)[i : i + 2], (t + "\0")[i]) for i in range(len(t) + 1))
        return min(n + cost(t) for t, n in ways), {t for t, n in ways if abs(n + cost(t) - min(m + cost(u) for u, m in ways)) < 1e-9}

    for word in ("1d1ott", "h3ll0", "cl0wwwn", "t-h-3"):
        assert toxicity.decode(word, model) in best(word)[1]


def test_toxic_words_are_found_behind_noise(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.fit(docs, table(spark, SF, "labels"), ~toxicity.held_out(5, 0))
    out = toxicity.score(docs, model, ["doc_id"]).join(table(spark, SF, "labels"), "doc_id").where(toxicity.held_out(5, 0)).toPandas()
    assert (out["predicted"] == out["toxic"]).mean() > 0.93 and out[out["toxic"] == 0]["predicted"].mean() < 0.03
    clean = "The and attion to thanedble the, anea. Eriner thanea."
    noisy = clean + " 1d10t m-o-r-o-n l o s e r"
    rows = [(1, clean), (2, clean + " idiot moron loser"), (3, noisy), (4, None), (5, ""), (6, clean * 3000), (6, clean * 3000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, score string, restored int")
    got = toxicity.score(df, model, df.columns, restored=True).orderBy("doc_id").collect()
    p = [r["predicted"] for r in got]
    assert p[0] == 0 and p[1] == 1 and p[2] == 1 and p[3:] == [0] * 4
    assert got[3]["score"] == got[4]["score"] and "idiot moron loser" in got[2]["restored"] and got[3]["restored"] is None
    assert toxicity.score(df.where("false"), model, ["doc_id"]).count() == 0


def test_runs_of_lone_letters_stay_in_their_text():
    r = toxicity.Restorer(chars({"abc": 5, "xyz": 5}))
    w = split_words(pa.array(["a b c", "x y z", None, "q"]), toxicity.TRIM)
    rows, words = r.extra(w)
    assert list(zip(rows.tolist(), words, strict=True)) == [(0, "abc"), (1, "xyz")]


def test_restored_words_replace_what_stood_there():
    r = toxicity.Restorer(chars({"idiot": 50, "abc": 5, "hello": 100}))
    w = split_words(pa.array(["hello 1d10t a b c hello!"]), toxicity.TRIM)
    stays, rows, words = r.restored(w, split_words(pa.array(["hello 1d10t a b c hello!"]), toxicity.OUTER))
    assert stays.tolist() == [True, False, False, False, False, True] and {"idiot", "abc"} <= set(words) and set(rows.tolist()) == {0}


def test_long_words_of_one_beginning_are_told_apart():
    k = toxicity.hashes(pa.array(["a" * 40 + "b", "a" * 40 + "c", "a" * 40 + "b"]))[:, 0]
    assert k[0] != k[1] and k[0] == k[2]


def test_signs_at_the_ends_of_words_are_letters_or_punctuation():
    r = toxicity.Restorer(chars({"stupid": 50, "asshole": 50, "shit": 50, "ass": 50, "idiot": 50, "hello": 100, "the": 500}))
    assert r.text("$tupid @sshole s h ! t") == "stupid asshole shit"
    assert r.text("hello! the (hello) !d!ot!") == "hello! the (hello) idiot"

    def found(text):
        rows, words = r.extra(split_words(pa.array(["hello", text]), toxicity.TRIM), split_words(pa.array(["hello", text]), toxicity.OUTER))
        assert set(rows.tolist()) <= {1}
        return set(words)

    for text, word in (("$tupid", "stupid"), ("($tupid)!!!!", "stupid"), ("@sshole!", "asshole"), ("@$$", "ass"), ("a$$, the", "ass"), ("s h ! t", "shit"), ("!d!0t!!", "idiot"), ("i d i o t !", "idiot"), ("$ h i t !", "shit")):
        assert word in found(text), (text, found(text))
    assert not found("hello the")


def test_words_of_any_length_and_script_are_decoded():
    r = toxicity.Restorer(chars({"idiot": 50, "hello": 100, "the": 500, "дурак": 50, "åse": 50}))
    for text, word in (("idi" + "o" * 60 + "t", "idiot"), (("-" * 12).join("idiot"), "idiot"), ("дуууурак", "дурак"), ("åååse", "åse"), ("idi" + "o" * 100_000 + "t", "idiot")):
        rows, words = r.extra(split_words(pa.array(["the hello", text]), toxicity.TRIM))
        assert list(zip(rows.tolist(), words, strict=True)) == [(1, word)], text[:80]
        assert r.text(text) == word
    some = ["ab", "bb", "b", "", "a1", "١a", "²1", "aab", "baa", "aaa", "xyyyz", "дуууу", "12", "111", "a" * 50 + "-"]
    maybe = toxicity.maybe_touched(pa.array(some))
    assert all(m for w, m in zip(some, maybe, strict=True) if toxicity.touched(w)) and not maybe[:4].any()
    assert not toxicity.touched("ab" * 200_000)  # in linear time


def test_every_trigram_is_in_the_model(spark):
    text = " ".join(chr(0x4E00 + k) + chr(0x4E00 + 7 * k % 20_000) for k in range(18_000))
    model = toxicity.char_model(spark.createDataFrame([(text,), ("abc abc",), (None,)], "text string"))
    want = {}
    for w in [*text.split(), "abc", "abc"]:
        for i in range(len(w) + 1):
            g = ("\0\0" + w + "\0")[i : i + 3]
            want[g] = want.get(g, 0) + 1
    assert len(want) > 50_000 and dict(zip(model.three[0].tolist(), model.three[1].tolist(), strict=True)) == {ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]): n for g, n in want.items()}


def test_long_words_are_read_to_their_end(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.choice((3, 40, 32, 33, 200))))
    texts = [" ".join(word("abcdefg") for _ in range(30)), "", " ".join(word("xyz") for _ in range(20)), "x" * 61]
    w = split_words(pa.array(texts), language.TRIM)
    cut = cut_long(w)
    names = cut.distinct.to_pylist()
    assert max(map(len, names)) <= 32
    for k, text in enumerate(texts):
        got, want = [names[c] for c in cut.codes[cut.bounds[k] : cut.bounds[k + 1]]], text.split()
        grams = lambda words, n: {x[i : i + n] for x in words for i in range(len(x) - n + 1)}
        assert all(grams(got, n) == grams(want, n) for n in (1, 2, 3, 4)) and {x[-4:] for x in want} <= {x[-4:] for x in got}
        assert len(got) == sum(max(1, -(-(len(x) - 3) // 29)) for x in want or [""])
    model = language.train(["aba bab " * 20, "cdc dcd " * 20], ["a", "c"])
    docs = spark.createDataFrame([(1, "ab" * 16 + "cd" * 300), (2, "ab" * 300)], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.label(docs, model, ["doc_id"]).orderBy("doc_id").collect()] == ["c", "a"]
    grams = toxicity.char_model(spark.createDataFrame([("a" * 32 + "bcd",)], "text string")).three[0].tolist()
    assert ord("c") << 42 | ord("d") << 21 in grams and ord("a") << 42 | ord("a") << 21 not in grams


def test_copies_and_many_languages_take_nothing_from_the_sample(spark, monkeypatch):
    rows = [(k, "copy of one text", "a") for k in range(300)] + [(1000 + k, f"text {k}", "a") for k in range(30)]
    rows += [(2000 + k, f"of language {k}", f"l{k}") for k in range(130)] + [(3000, None, "n"), (3001, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {}
    monkeypatch.setattr(language, "train", lambda texts, langs: got.update(texts=texts, langs=langs))
    language.fit(docs, F.lit(True), per_language=20)
    pairs = set(zip(got["texts"], got["langs"], strict=True))
    assert len(pairs) == len(got["texts"]) and set(got["langs"]) == {"a", *(f"l{k}" for k in range(130))} and got["langs"].count("a") == 20
    language.fit(docs, F.lit(True), per_language=50)
    assert got["langs"].count("a") == 31
    # 15 clean texts and 16 toxic ones, one of them in 300 copies.
    labels = docs.where("lang = 'a'").select("doc_id", F.when(F.col("doc_id") < 1000, 1).otherwise(F.pmod("doc_id", F.lit(2))).cast("int").alias("toxic"))
    sizes, real = {}, toxicity.materialize

    def kept(d, name):
        made = real(d, name)
        sizes["n"] = {r["toxic"]: r["count"] for r in made.groupBy("toxic").count().collect()}
        return made

    monkeypatch.setattr(toxicity, "materialize", kept)
    toxicity.fit(docs, labels, F.lit(True), most=12)
    assert sizes["n"] == {0: 12, 1: 12}


def test_lean_passes_batches_on():
    b = pa.record_batch([pa.array([1, 2])], names=["a"])
    assert list(lean(lambda it: it)(iter([b]))) == [b]
    assert random.Random(1).random() < 1
