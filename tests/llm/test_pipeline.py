from pyspark.sql import functions as F

import corpus_pipeline as P
from pageloom.session import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_work(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, seen, SF)
        assert out.columns == columns, name
        seen = out
    pieces = P.STAGES[-1][1](spark, seen, SF).toPandas()
    assert len(pieces) and [n for n, _ in P.STAGES] == ["toxicity", "language_id", "jaccard_join", "mixing", "packing"]


def test_stages_bear_odd_rows(spark):
    rows = [(1, None, "en", None, 0), (None, "the and of", None, "a", 1), (2, "", "en", "a", 0), (3, "12 34", "en", "a", 5), (4, "the and to the " * 20, "en", "a", 9), (4, "the and to the " * 20, "en", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert P.drop_unknown_language(spark, docs, SF).count() == 3
    assert P.drop_near_copies(spark, docs, SF).count() == 5
    assert P.mix_sources(spark, docs, SF).columns == docs.columns
    assert P.pack_sequences(spark, docs, SF).count() >= 6
    for _, stage in P.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_run_is_the_stages_in_order(spark):
    got = P.run(spark, SF).toPandas()
    assert got["length"].sum() > 0 and set(got.columns) >= {"doc_id", "sequence_id", "ids_crc32"}


def test_stages_bear_long_texts_and_clashing_names(spark):
    names = ["score", "predicted", "copies", "th", "copy", "rank", "lang_pred", "source_size"]
    texts = ["the and to of the in " * 40_000, "the and er tion " * 12, "the and er tion " * 12, "the of and in " * 9 + " idiot moron loser stupid idiot moron"]
    rows = [(k, t, "en", "a", 1, *names) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names))
    for name, stage in P.STAGES[:-1]:
        sf = SF.replace("0.001", "0.01") if name == "toxicity" else SF  # the smallest tables hold too few labels to learn from
        base = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(c).alias(c) for c in names])
        every = base.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000))
        out = stage(spark, every, sf)
        assert out.columns == docs.columns, name
        kept = out.where("doc_id >= 1000000")
        assert {tuple(r) for r in kept.select(*names).distinct().collect()} == {tuple(names)}, name
        ids = {r[0] - 1_000_000 for r in kept.select("doc_id").collect()}
        assert ids == {"toxicity": {0, 1, 2}, "language_id": {0, 1, 2, 3}, "jaccard_join": {0, 1, 3}}.get(name, ids), name
    assert P.pack_sequences(spark, docs, SF).where("doc_id = 0").agg(F.sum("length")).first()[0] > 200_000
