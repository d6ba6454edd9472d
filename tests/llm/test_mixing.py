import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from pageloom.llm.mixing import fit, mix


def water(sizes, weights, budget, cap):
    """Targets by stopping at the cap and resharing, as the rule says."""
    left, open_, out = budget * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i] + 1e-9]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = cap * sizes[i]
            open_.discard(i)
        left = budget * sum(sizes) - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def test_fit_reaches_budgets_exactly_where_brute_force_does():
    rnd = random.Random(1)
    for _ in range(60):
        lengths = np.array(sorted(rnd.sample(range(1, 30), 4)))
        counts = np.array([rnd.randint(1, 3) for _ in lengths])
        sums = {int(sum(a * b for a, b in zip(c, lengths, strict=True))) for c in itertools.product(*[range(n + 1) for n in counts])}
        budget = rnd.randint(1, int((lengths * counts).sum()))
        take = fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert int((take * lengths).sum()) == max(s for s in sums if s <= budget)


def best_sum(lengths, counts, budget):
    """Largest reachable sum, with a bit for every sum."""
    reach, mask = 1, (1 << budget + 1) - 1
    for size, n in zip(lengths, counts, strict=True):
        k = 1
        while n > 0:
            k = min(k, n)
            reach |= reach << k * size & mask
            n -= k
            k *= 2
    return reach.bit_length() - 1


def test_fit_reaches_the_best_sum_of_long_and_of_many_documents():
    rnd = random.Random(6)
    tables = [([40_000, 50_000], [1, 1], 50_000)]
    for k in range(240):
        lengths = rnd.sample(range(500, 20_001), rnd.randint(1, 8)) if k % 2 else rnd.sample(range(1, 400), rnd.randint(1, 8))
        counts = [rnd.randint(1, 6) if k % 2 else rnd.randint(20, 60) for _ in lengths]
        tables.append((lengths, counts, rnd.randint(0, sum(a * b for a, b in zip(lengths, counts, strict=True)))))
    for lengths, counts, budget in tables:
        take = fit(np.array(lengths), np.array(counts), budget)
        assert (take >= 0).all() and (take <= np.array(counts)).all()
        assert int((take * np.array(lengths)).sum()) == best_sum(lengths, counts, budget), (lengths, counts, budget)


def test_callers_columns_come_back_whatever_their_names(spark):
    names = ["take", "before", "whole", "rank", "cell", "doc", "skey", "h", "n", "copy", "row"]
    rows = [(k, "a b c", "s", *names) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names))
    got = mix(df).collect()
    assert sorted(tuple(r)[: len(rows[0])] for r in got) == rows and sum(r["copies"] for r in got) == 30


def test_mix_meets_targets(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 40)), f"s{min(i % 9, 5)}", 7, "x") for i in range(900)]
    rows += [(1000 + i, "a b c", None, 7, "x") for i in range(30)] + [(5000, None, "s0", 7, "x"), (5001, "", "s1", 7, "x"), (1, rows[1][1], "s1", 7, "x"), (6000, "w " * 3000, "s5", 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")
    out = mix(df).toPandas()
    assert len(out) == len(rows)
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    sizes = [sum(len((r[1] or "").split()) for r in rows if r[2] == n) for n in names]
    want = water(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0)
    for n, s, t in zip(names, sizes, want, strict=True):
        part = out[out["source"].isna() if n is None else out["source"] == n]
        assert (part["source_size"] == s).all() and np.allclose(part["target"], t)
        assert abs((part["size"] * part["copies"]).sum() - t) <= 2, n
    assert out["copies"].max() <= 2
    again = mix(df.repartition(7)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert sorted(map(tuple, out[key].values.tolist())) == sorted(map(tuple, again[key].values.tolist()))


def test_mix_of_nothing(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    one = mix(spark.createDataFrame([(1, "", "a")], "doc_id long, text string, source string")).select(F.sum("copies"), F.sum("target")).first()
    assert one[1] == 0
