import random

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text as X


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        ("well-known", "wellknown"), ("a\nb", "ab"), ("a—b", "a b"), ("a+b|c=`d`", "a+b|c=`d`"), ("<p>Hi</p> <b1>x", "hi b1x"), ("", ""),
        ("<h1>T</h1>   \x1c é", "t é"), ("who [?] me", "who me"), ("<a href=x>y", "a href=xy"), ("'quote' \"q\" \\", "quote q"),
    ],
)
def test_clean(spark, raw, cleaned):
    assert one(spark, X.clean(F.col("s")), s=raw) == cleaned


def test_tokens_of_nothing(spark):
    assert one(spark, X.tokens(F.col("s")), s="") == [] and one(spark, X.tokens(F.col("s")), s=" a  b ") == ["a", "b"]


def test_py_slice_is_pythons(spark):
    items = list(range(6))
    pairs = [(a, b) for a in range(-9, 10) for b in range(-9, 10)]
    df = spark.createDataFrame([(items, a, b) for a, b in pairs], "i array<int>, a int, b int")
    for r in df.select("a", "b", X.py_slice(F.col("i"), F.col("a"), F.col("b")).alias("r")).collect():
        assert r["r"] == items[r["a"] : r["b"]]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_word_distance(spark):
    rnd = random.Random(1)
    pairs = [([rnd.choice("abcd") for _ in range(rnd.randint(0, 8))], [rnd.choice("abcd") for _ in range(rnd.randint(0, 8))]) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for r in df.select("a", "b", X.word_distance(F.col("a"), F.col("b")).alias("d")).collect():
        assert r["d"] == distance(r["a"], r["b"])


def test_match_ratio(spark):
    df = spark.createDataFrame([("abc", "abd"), ("", ""), ("abc", "xyz"), ("abc", "abc"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(X.match_ratio("a", "b")).collect()] == [pytest.approx(2 / 3), 1.0, 0.0, 1.0, None]


def test_paths(spark):
    p = "bucket/x/year_1999_p3.tif.gz"
    assert one(spark, X.file_stem(F.col("p")), p=p) == "year_1999_p3" and one(spark, X.suffix_key(F.col("p")), p=p) == "p3"
    assert one(spark, X.last_parts(F.col("p"), 2), p=p) == ["x", "year_1999_p3.tif.gz"] and one(spark, X.last_parts(F.col("p"), 9), p="a/b") == ["a", "b"]
    assert one(spark, X.zero_pad(F.col("n")), n=7) == "007" and one(spark, X.zero_pad(F.col("n")), n=12345) == "12345"
    assert one(spark, X.keep_key(F.col("p"), ".gz", "year", 2), p=p) and not one(spark, X.keep_key(F.col("p"), ".gz", "year", 0), p=p)


def test_closest_takes_the_first_of_equals(spark):
    assert one(spark, X.closest(F.col("i"), F.col("t")), i=[2, 8, 4], t=3) == 2 and one(spark, X.closest(F.expr("cast(array() as array<int>)"), F.lit(3))) is None


def test_wrap_and_tags(spark):
    assert one(spark, X.wrap(F.col("w"), 2), w=["a", "b", "c", "d"]) == "a b c\n d"
    assert one(spark, X.tags(F.col("s")), s="<p><b><p></p><a x>") == ["<b>", "<p>"]
