"""A training corpus out of documents: five stages, each an operator of pageloom.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import jaccard, language, mixing, packing, toxicity
from pageloom.session import materialize, settle, table

#: Least share of words of one language for a text to pass.
LEAST_LANGUAGE = 1 / 3


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with all columns but text renamed to c0, c1, .. (names that no operator adds), and these names in order."""
    names = [c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts to be clean.

    Null and empty texts have no evidence against them and stay. Repeated rows share their text's fate,
    texts of any length are scored whole, other columns (whatever their names) pass, an empty table gives no rows.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(5, 0))
    rows, names = _numbered(docs)
    return toxicity.score(rows, model, names).where("predicted = 0").select(*names).toDF(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, of which one language holds at least a third of the words.

    Null texts and those without a letter go; exactly a third is enough. Repeated rows share their text's fate, texts of
    any length are one chain, other columns (whatever their names) pass, an empty table gives no rows.
    """
    model = language.fit(docs, ~language.held_out(4, 2))
    rows, names = _numbered(docs)
    found = language.label(rows, model, names)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)).select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest (doc_id, text hash).

    Texts that are null or without words all stay; of rows equal in doc_id and text one stays.
    Other columns (whatever their names) pass, texts are read whole, an empty table gives no rows.
    """
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source. Null and empty texts have size 0 and come in the whole passes alone; repeated rows are
    separate documents. Other columns (whatever their names) pass, texts of any length are one item, an empty table gives no rows.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mixed = mixing.mix(docs.select(F.struct(*columns).alias("row"), "doc_id", "text", "source"))
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with a checksum of their ids.

    A null text is an empty one (its end id alone), a null source a source; repeated rows are separate documents, texts
    of any length are cut over sequences. Other columns are ignored, an empty table gives no rows.
    """
    return packing.digest(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all documents; each one's rows are a table, from which the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        settle(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
