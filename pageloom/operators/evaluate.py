"""Whole evaluations of recognised pages: many files at once, failures as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import clean, file_stem, last_parts, suffix_key, text_distance, tokens
from pageloom.operators import align as L
from pageloom.operators import metrics as M
from pageloom.sources.readers import join_by_key

PAGE = ["file"]


def truth_words(lines: DataFrame) -> DataFrame:
    """file, text, of true texts given as lines (file, line_no, line): joined by blanks before cleaning."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return lines.groupBy("file").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), " ").alias("text"))


def line_blocks(lines: DataFrame) -> DataFrame:
    """file, block_id, ind, word: each recognised line is a block; lines without words are none."""
    return lines.select("file", F.col("line_no").cast("int").alias("block_id"), F.posexplode(tokens(clean(F.col("line")))).alias("ind", "word"))


def word_blocks(texts: DataFrame, size: int = 100) -> DataFrame:
    """The same for texts without useful lines: a block every ``size`` words."""
    return L.fixed_blocks(L.word_rows(texts, PAGE), PAGE, size)


def ranges_of(blocks: DataFrame, truth: DataFrame) -> DataFrame:
    """Where each block lies in its file's true text (file, text); blocks without any rare word lie nowhere."""
    hits = L.word_hits(blocks, L.word_rows(truth, PAGE), PAGE, PAGE)
    found = L.align_ranges(L.block_sizes(blocks, PAGE), hits, PAGE)
    lost = L.block_sizes(blocks, PAGE).join(found, [*PAGE, "block_id"], "left_anti")
    none = [F.lit(None).cast("int").alias("d"), F.lit(None).cast("long").alias("score"), F.lit(-1).alias("i_min"), F.lit(-1).alias("i_max")]
    return found.unionByName(lost.select(*PAGE, "block_id", "n", *none))


def edit_accuracy(blocks: DataFrame, truth: DataFrame, inclusive: bool = True) -> DataFrame:
    """file, n_blocks, total, accuracy, error: character-weighted over the blocks' true texts."""
    ordered = F.array_sort(F.collect_list(F.struct("ind", "word")))
    texts = blocks.groupBy(*PAGE, "block_id").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("block_text"))
    placed = L.range_text(ranges_of(blocks, truth), truth, PAGE, inclusive=inclusive)
    return M.char_scores(placed.join(texts, [*PAGE, "block_id"]), PAGE)


def read_order(blocks: DataFrame, truth: DataFrame) -> DataFrame:
    """file, n_blocks, out_of_order, accuracy of the blocks' order in the true text."""
    return L.read_order_accuracy(ranges_of(blocks, truth), PAGE)


def path_triples(paths: DataFrame, kinds: Sequence[str] = ("engine_a", "engine_b", "ground_truth")) -> DataFrame:
    """key, and a path below each kind's folder (two engines' outputs, the true text), out of the last two parts of a path."""
    two = last_parts(F.col("path"), 2)
    folder, stem = F.element_at(two, 1), file_stem(F.col("path"))
    d = paths.withColumn("key", F.concat_ws("/", folder, stem))
    return d.select("path", "key", *[F.concat_ws("/", F.lit(kind), folder, F.concat(stem, F.lit(".txt"))).alias(kind) for kind in kinds])


def compare_engines(triples: DataFrame, metrics: Sequence[str] = ("wer", "lev"), cleaned: bool = True) -> tuple[DataFrame, DataFrame]:
    """(key, metric, err_a, err_b) and (key, reason): two engines' texts (a, b) against the true text (truth).

    A row that misses a text is a failure, not an error of the whole batch.
    """
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("a", "b", "truth")])
    d = triples.withColumn("reason", missing)
    ok = d.where("reason = ''")
    out = None
    for m in metrics:
        side = [M.error_report(ok.select("key", "truth", F.col(s).alias("guess")), [m], cleaned).select("key", F.col(m).alias(f"err_{s}")) for s in ("a", "b")]
        one = side[0].join(side[1], "key").select("key", F.lit(m).alias("metric"), "err_a", "err_b")
        out = one if out is None else out.unionByName(one)
    return out, d.where("reason <> ''").select("key", "reason")


def zip_texts(names: DataFrame, texts: DataFrame) -> DataFrame:
    """file, ordinal, text: the n-th name (file, ordinal) with the n-th text (text, ordinal); what has no partner is left out."""
    return names.join(texts, "ordinal").select("file", "ordinal", "text")


def suffix_errors(files: DataFrame, truth: DataFrame) -> DataFrame:
    """file, truth_file, chars, bad, error: recognised texts (file, text) against the true text whose name ends in the same key.

    The key is what follows the last underscore of a name. Both texts are cleaned; error is the edit distance over the
    true text's characters, null without a true text or where that is empty.
    """
    guess = files.select("file", F.col("text").alias("guess"))
    d = join_by_key(guess, truth, suffix_key(F.col("file")), suffix_key(F.col("file")))
    t, g = clean(F.col("truth")), clean(F.col("guess"))
    d = d.select("file", "truth_file", F.length(t).alias("chars"), text_distance(t, g).alias("bad"))
    return d.withColumn("error", F.try_divide("bad", "chars"))


def files_with(texts: DataFrame, tag: str) -> DataFrame:
    """Files (file, text) whose text holds ``tag``; of rows with one file the last by ordinal counts."""
    last = texts.groupBy("file").agg(F.max(F.struct("ordinal", "text"))["text"].alias("text"))
    return last.where(F.col("text").contains(tag)).select("file")


def find_file(names: DataFrame, keyword: str) -> DataFrame:
    """The first name (name, ordinal) that holds ``keyword``; no row without one."""
    return names.where(F.col("name").contains(keyword)).agg(F.min(F.struct("ordinal", "name"))["name"].alias("name")).where("name IS NOT NULL")


def without_keyword(names: DataFrame, keyword: str) -> DataFrame:
    return names.where(~F.col("name").contains(keyword))


def place_of(paths: DataFrame, wanted: str) -> DataFrame:
    """place from 1 of the first path (path, ordinal) that ends in the last two parts of ``wanted``."""
    tail = "/".join(wanted.split("/")[-2:])
    same = F.array_join(last_parts(F.col("path"), 2), "/") == tail
    return paths.where(same).agg((F.min("ordinal") + 1).alias("place")).where("place IS NOT NULL")
