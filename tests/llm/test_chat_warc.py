import hashlib
import random

from pyspark.sql import functions as F

from pageloom.llm import chat, warc


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rnd = random.Random(4)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "|im_start|>", "|im_end|>", "<<SYS>>", "<</SYS>>", "</s>", "[INST]", "x", "\n", " ", "é", "|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t"))).withColumn("b", chat.unescape(F.col("e")))
    for r in df.collect():
        assert r["b"] == r["t"]
        assert not any(c in r["e"] for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"))


def test_prefix_targets(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "user", "hi <s>"), (1, 2, "assistant", "[INST] yo"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 0, "user", "alone"), (None, 0, "assistant", "no id"), (3, None, "assistant", "first"), (3, 1, "a%\nb", "x"), (3, 1, "a%\nb", "x"), (4, 0, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, upto int")
    out = chat.expand(df)
    back = out.select("conv_id", "upto", "trainable", chat.turns_of(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_len")).alias("loss")).collect()
    got = {(r["conv_id"], r["upto"]): r for r in back}
    assert set(got) == {(1, 3), (1, 5), (1, 6), (2, 1), (None, 1), (3, 1), (3, 3), (4, 1)}
    assert got[1, 3]["loss"] == "[INST] yo" and got[1, 5]["loss"] == "" and got[None, 1]["loss"] == "no id"
    assert [(t["role"], t["text"]) for t in got[1, 6]["turns"]] == [(r[2], r[3] or "") for r in rows[:6]]
    assert [t["role"] for t in got[3, 3]["turns"]] == ["assistant", "a%\nb", "a%\nb"]
    assert [r for r in got if not got[r]["trainable"]] and not got[2, 1]["trainable"] and got[1, 3]["trainable"]
    assert chat.expand(df.where("false")).count() == 0


def test_prefix_targets_run_without_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.expand(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_canonical_urls(spark):
    pairs = {
        "HTTP://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#f": "example.com/a?a=1&b=2", "https://example.com/a": "example.com/a", "http://example.com/": "example.com",
        "https://e.org/p?ref=1": "e.org/p", "not a url": "not a url",
    }
    df = spark.createDataFrame([(u,) for u in [*pairs, None]], "u string").select("u", warc.canonical_url(F.col("u")).alias("c"))
    assert {r["u"]: r["c"] for r in df.collect()} == {**pairs, None: None}


def test_revisits_resolve_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        url = "http://hot.org/" if rnd.random() < 0.4 else f"http://h{rnd.randint(0, 20)}.org/p"
        kind = rnd.choice(["response", "response", "revisit"])
        status = 304 if kind == "revisit" else rnd.choice([200, 200, 404])
        ts = rnd.choice([None, *[rnd.randint(0, 300)] * 30])
        tag = rnd.choice([None, 'W/"a"', '"a"', '"b"'])
        lm = rnd.choice([None, "x", "y"])
        rows.append((i, None if rnd.random() < 0.02 else url, ts, kind, status, tag, lm, {"ETag": tag or "-", "Server": f"n{i}", "Content-Type": f"t{i}"}, f"body{i}" if kind == "response" else None, 1))
    rows += [rows[5], rows[7]]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, rtype string, status int, etag string, last_modified string, headers map<string,string>, payload string, resolution int")
    out = warc.resolve_revisits(df, cuts=8).collect()
    assert len(out) == len(rows)
    by_id = {r[0]: r for r in rows}
    for r in out:
        if r["rtype"] != "revisit":
            assert r["resolution"] == "response"
            continue
        prior = [(x[2], x[0]) for x in by_id.values() if x[3] == "response" and x[4] == 200 and x[1] is not None and x[1] == r["url"] and None not in (x[2], r["ts"]) and x[2] < r["ts"]]
        if not prior:
            assert r["resolution"] == "no_prior" and r["resolved_id"] is None
            continue
        full = by_id[max(prior)[1]]
        bare = lambda t: t.removeprefix("W/")
        same = bare(full[5]) == bare(r["etag"]) if full[5] and r["etag"] else full[6] == r["last_modified"] if full[6] and r["last_modified"] else None
        assert r["resolution"] == {True: "resolved", False: "mismatch", None: "unverified"}[same]
        if same:
            assert r["resolved_id"] == full[0] and r["merged_payload"] == full[8]
            assert r["merged_headers"] == {"content-type": f"t{full[0]}", "server": f"n{full[0]}", "etag": r["etag"] or "-"}
    assert warc.resolve_revisits(df.where("false")).count() == 0


def test_digest_of_read_back(spark):
    from pageloom.llm.chat import op7_prefix_targets

    r = op7_prefix_targets(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(text) and r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
