"""Queries of the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import text as X
from pageloom.session import table

#: Java's Unicode white space and the four separators, for a regular expression of RE2.
SPACE_SQL = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def tokens_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{SPACE_SQL}'), lambda w: w <> '')"


def plain_sql(x: str) -> str:
    """Cleaning up to the white space."""
    x = f"regexp_replace(regexp_replace(lower({x}), '<[a-z]*>', '', 'g'), '</[a-z]*>', '', 'g')"
    x = f"replace(replace({x}, '<h1>', ''), '</h1>', '')"
    marks = X.PUNCTUATION.replace("'", "''")
    x = f"translate({x}, '{marks}', '')"
    return f"replace(replace(replace(replace({x}, chr(13), ''), chr(10), ''), '[?]', ''), '—', ' ')"


def clean_tokens_sql(x: str) -> str:
    return tokens_sql(plain_sql(x))


def clean_sql(x: str) -> str:
    return f"array_to_string({clean_tokens_sql(x)}, ' ')"


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.clean(F.col("text")).alias("cleaned"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.tokens(X.clean(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("long").alias("n_words"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's words once, in order of first use."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.array_distinct(X.tokens(X.clean(F.col("text")))), " ").alias("words"))


def tag_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(X.tags(F.col("html")), ",").alias("tags"))


def tag_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.remove_tags(X.remove_headers(F.col("html"))).alias("stripped"))


def url_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(X.last_parts(u, 2), "/").alias("last_two"), X.file_stem(u).alias("stem"), X.suffix_key(u).alias("suffix"), X.zero_pad(F.col("page_id")).alias("padded"))


def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(X.keep_key(F.col("url"), ".html", "/en/", 4)).select("page_id", "url")


def wrap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", X.wrap(F.split("text", " "), 7).alias("wrapped"))


QUERIES = {f.__name__: f for f in (clean_text, token_counts, distinct_words, tag_inventory, tag_strip, url_key, key_filter, wrap_lines)}
SQL = {
    "clean_text": f"SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents",
    "token_counts": f"SELECT doc_id, len(t) AS n_words, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, {clean_tokens_sql('text')} AS t FROM documents)",
    "distinct_words": f"""SELECT item_id, string_agg(w, ' ' ORDER BY i) AS words FROM (SELECT item_id, w, min(i) AS i FROM (
        SELECT item_id, unnest({clean_tokens_sql('text')}) AS w, generate_subscripts({clean_tokens_sql('text')}, 1) AS i FROM benchmark) GROUP BY item_id, w) GROUP BY item_id""",
    "tag_inventory": "SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '<[a-z]*>'))), ',') AS tags FROM pages",
    "tag_strip": "SELECT page_id, regexp_replace(regexp_replace(replace(replace(html, '<h1>', ''), '</h1>', ''), '<[a-z]*>', '', 'g'), '</[a-z]*>', '', 'g') AS stripped FROM pages",
    "url_key": """SELECT page_id, array_to_string(p[-2:], '/') AS last_two, s AS stem, string_split(s, '_')[-1] AS suffix, CASE WHEN length(n) < 3 THEN lpad(n, 3, '0') ELSE n END AS padded
        FROM (SELECT page_id, string_split(url, '/') AS p, string_split(string_split(url, '/')[-1], '.')[1] AS s, page_id::VARCHAR AS n FROM pages)""",
    "key_filter": "SELECT page_id, url FROM pages WHERE suffix(url, '.html') AND contains(url, '/en/') AND len(string_split(url, '/')) = 5",
    "wrap_lines": """SELECT item_id, string_agg(w || CASE WHEN i % 7 = 0 AND i > 0 THEN chr(10) ELSE '' END, ' ' ORDER BY i) AS wrapped FROM (
        SELECT item_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM benchmark) GROUP BY item_id""",
}
