"""The driver keeps and rewrites a plan while its stages finish, so that its size counts."""

from pageloom.llm import jaccard


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_what_jaccard_returns_is_a_small_plan(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "another text of five words"), (4, None)], "doc_id long, text string")
    kept = jaccard.one_of_each(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert exchanges(kept) <= 15
    assert exchanges(jaccard.near_duplicates(docs)) <= 15
