import pytest
from pyspark.sql import functions as F

from newsloom.functions import keep_letters, settle, strip_punctuation, white_split, word_count


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column("v")).first()[0]


@pytest.mark.parametrize("text, count", [("", 1), ("  a b ", 4), (None, None), ("a\tb\nc", 3)])
def test_word_count(spark, text, count):
    assert one(spark, word_count, text) == count


def test_split_keeps_no_break_space(spark):
    assert one(spark, white_split, " a b") == ["", "a b"]


@pytest.mark.parametrize("text, kept", [
    ("l'économie 2024", "léconomie "),
    ("ÉCOLOGIE", "écologie"),
    ("œuvre Straße", "uvre strae"),
    ("x-y\tz\n", "xy\tz\n"),
    ("ÿ Ÿ ñ Ç", "ÿ ÿ ñ ç"),
])
def test_keep_letters(spark, text, kept):
    assert one(spark, keep_letters, text) == kept


def test_strip_punctuation(spark):
    assert one(spark, strip_punctuation, "Paris !, ok. (a)?") == "Paris  ok (a)"


def test_settled_column_is_not_copied_into_filters(spark):
    df = spark.range(3).select("id", F.col("id").cast("string").alias("text"))
    settled = settle(df, "upper", F.upper(F.concat("text", F.lit("x"))))
    plan = settled.where(F.length("upper") > 1).select("upper")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
    assert [r.upper for r in settled.orderBy("id").collect()] == ["0X", "1X", "2X"]
