"""Chat formatting: prefix-target expansion, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.session import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: What follows the first character of a control string (ours and other templates').
_REST = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"
ESCAPE = r"([<\[])(\\*)" + _REST
UNESCAPE = r"([<\[])\\(\\*)" + _REST


def escape(text: Column) -> Column:
    """One backslash after the first character of every control string.

    A control string that already holds backslashes there gets one more, so
    the step is reversible and its result holds no control string.
    """
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _role_in(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def expand(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """One example per assistant turn, with all preceding turns as context.

    Returns conv_id, upto (turns in the example), trainable, formatted,
    loss_start (code points before the mask) and loss_len: only the reply's
    text is under the mask. A conversation that does not end in such a turn
    also gives one row that is not trainable and holds all its turns, so
    nothing is lost.

    Rows are put in order by turn (null first), then role, then text, so ties
    and repeated rows have a defined place. Null text or role counts as empty;
    null conv_id is a conversation. An empty table gives no rows; other
    columns are ignored. An example holds its conversation's whole prefix by
    definition, so a conversation must fit a task; examples are made one at a
    time. The grouping stays within conv_id: one shuffle.
    """
    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    turns = conversations.select("conv_id", F.struct(F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    c = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    made = F.transform("t", lambda t: F.concat(F.lit(OPEN), _role_in(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE + "\n")))
    c = c.select("conv_id", made.alias("made"), F.transform("t", lambda t: t["role"] == target_role).alias("is_target"))
    n = F.size("made")
    c = c.select("conv_id", "made", "is_target", F.explode(F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("is_target", i) | (i == n))).alias("upto"))
    head = F.length(F.lit(OPEN)) + F.length(_role_in(F.lit(target_role))) + 1
    own = F.element_at("made", F.col("upto"))
    c = c.select(
        "conv_id", "upto", F.element_at("is_target", F.col("upto")).alias("trainable"),
        F.array_join(F.slice("made", 1, F.col("upto") - 1), "").alias("context"), own.alias("own"),
    )
    return c.select(
        "conv_id", "upto", "trainable", F.concat("context", "own").alias("formatted"),
        (F.length("context") + head).alias("loss_start"),
        F.when(F.col("trainable"), F.length("own") - head - F.length(F.lit(CLOSE)) - 1).otherwise(0).alias("loss_len"),
    )


def turns_of(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted example."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(p: Column) -> Column:
        body = F.substring(p, F.lit(len(OPEN) + 1), F.length(p))
        role = F.substring_index(body, "\n", 1)
        return F.struct(_role_out(role).alias("role"), unescape(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))

    return F.transform(parts, turn)


def masked_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under a loss mask, unescaped."""
    return unescape(F.substring(formatted, start + 1, length))


def op7_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    examples = expand(rows.unionByName(own))
    loss = F.when(F.col("trainable"), masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_len")))
    back = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "upto").alias("longest"),
        F.sort_array(F.collect_list(F.when(loss.isNotNull(), F.struct("upto", loss.alias("text"))))).alias("loss"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    back = back.select("conv_id", turns_of(F.col("longest")).alias("turns"), F.array_join(F.transform("loss", lambda x: x["text"]), "").alias("loss"), "formatted_chars")
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


OP7_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)
), made AS (
  SELECT *, {len(OPEN) + len(CLOSE) + 2}
    + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '{ESCAPE}', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '{ESCAPE}', '\1\\\2\3', 'g')) AS size
  FROM rows
), run AS (
  SELECT *, sum(size) OVER w AS upto, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM made WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant' OR is_last), 0) AS BIGINT) AS formatted_chars
FROM run GROUP BY conv_id
"""
