import random

import pytest

from pageloom.llm.jaccard import DEPTH, LEAST_SHARED, SAMPLES, THRESHOLD, near_duplicates, one_of_each, runs_for


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def corpus():
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    texts = []
    for i in range(150):
        texts.append([rnd.choice(vocab) for _ in range(rnd.randint(3, 150))] + (passage if i % 3 == 0 else []))
    hot = [rnd.choice(vocab) for _ in range(200)]
    for _ in range(150):  # a large group of near copies, each different
        t = list(hot)
        for _ in range(rnd.randint(1, 3)):
            t[rnd.randrange(len(t))] = rnd.choice(vocab) + "x"
        texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(500 + i, rows[i][1].upper().replace(" ", "\n ")) for i in range(40)]
    return rows + [(600, None), (601, ""), (602, " \n"), (603, "one two"), (604, "One  two"), (3, rows[3][1]), (None, rows[3][1]), (605, "long " * 30000)]


def test_join_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, th string")
    out = near_duplicates(df).toPandas()
    assert len(out) == len(rows)
    sets = [shingles(t) for _, t in rows]
    ids = [r[0] for r in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    key = lambda d: -1 if d is None or d != d else int(d)
    want = sorted((key(d), n[i], least[find(i)]) for i, d in enumerate(ids))
    got = sorted((key(r.doc_id), r.n_links, int(r.class_id)) for r in out.itertuples())
    assert got == want

    kept = one_of_each(df).toPandas()
    assert list(kept.columns) == df.columns and set(kept["th"]) == {"x"}
    bare = sum(not s for s in sets)
    assert len(kept) == bare + len({find(i) for i in range(len(rows)) if sets[i]})


def test_callers_columns_come_back_whatever_their_names(spark):
    names = ["doc_id", "text", "th", "id", "words", "single", "rank", "doc", "whole", "component"]
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text, *names[2:]), (2, text, *names[2:]), (3, None, *names[2:])], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names[2:]))
    assert sorted(map(tuple, one_of_each(df).collect())) == [(1, text, *names[2:]), (3, None, *names[2:])]


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(base[: k % 97] + [f"x{k}"] + base[k % 97 + 1 :])) for k in range(900)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).toPandas()
    sets = [shingles(t) for _, t in rows]
    want = sum(len(sets[0] & s) >= 0.8 * len(sets[0] | s) for s in sets[1:])
    assert set(out["class_id"]) == {0} and out.loc[out["doc_id"] == 0, "n_links"].item() == want


def test_no_texts(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None), (1, None)], "doc_id long, text string")).count() == 2


def test_runs_reach_the_recall_over_shared_samples():
    rnd, runs, missed, trials = random.Random(5), runs_for(0.97), 0, 4000
    for _ in range(trials):  # a pair at similarity 0.8: which samples agree, then runs of chosen paths over them
        agree = [rnd.random() < THRESHOLD for _ in range(SAMPLES)]

        def met(level):
            return level == DEPTH or any(agree[rnd.randrange(SAMPLES)] and met(level + 1) for _ in range(1 + (rnd.random() < 0.25)))  # noqa: B023

        missed += sum(agree) < LEAST_SHARED * SAMPLES or not any(met(0) for _ in range(runs))
    assert missed / trials < 0.03 + 4 * (0.03 / trials) ** 0.5
    with pytest.raises(ValueError):
        runs_for(0.999999)


def test_runs_grow_with_recall_and_depth():
    assert runs_for(0.9999) > runs_for(0.99) and runs_for(0.99, depth=4) > runs_for(0.99, depth=1)
