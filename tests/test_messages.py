import json

import pytest

from newsloom.operators import article_lines, flatten_articles, to_messages


def flat(spark, *values):
    return flatten_articles(spark.createDataFrame([(v,) for v in values], "value string"))


def test_defaults(spark):
    row = flat(spark, '{"articles":[{}]}').first()
    assert row.asDict() == {
        "title": "No title", "author": "Unknown", "description": "No description", "url": "No URL",
        "publishedAt": "Unknown date",
    }


@pytest.mark.parametrize("article, title", [
    ({"title": None}, "No title"), ({}, "No title"), ({"title": ""}, ""), ({"title": 5}, "5"),
    ({"title": True}, "true"), ({"title": {"a": [1]}}, '{"a":[1]}'), (7, "No title"), ("text", "No title"), (None, "No title"), ([], "No title"),
])
def test_titles(spark, article, title):
    assert flat(spark, json.dumps({"articles": [article]})).first().title == title


@pytest.mark.parametrize("value", [
    "{bad", "", None, "[1]", '{"articles":"[1]"}', '{"articles":"a"}', '{"articles":[{"title":"a"}', '{"articles":7}',
    '{"articles":{}}', '{"articles":[]}', "{}", '{"articles":null}', "5",
])
def test_no_articles(spark, value):
    assert flat(spark, value).count() == 0


def test_bad_message_does_not_hide_others(spark):
    good = '{"articles":[{"title":"a"},{"title":"b"}]}'
    assert sorted(r.title for r in flat(spark, good, "{bad", good).collect()) == ["a", "a", "b", "b"]


def test_repeated_field_keeps_the_last(spark):
    assert flat(spark, '{"articles":[{"title":"a","title":"b"}]}').first().title == "b"
    assert flat(spark, '{"articles":[],"articles":[{"title":"a"}]}').first().title == "a"


def test_large_message(spark):
    """Larger than a variant holds."""
    rows = spark.range(1).selectExpr("""concat('{"articles":[{"title":"', repeat('x', 18000000), '"},{"url":"u"}]}') as value""")
    found = flatten_articles(rows).selectExpr("length(title) as n", "url").collect()
    assert sorted(map(tuple, found)) == [(8, "u"), (18_000_000, "No URL")]


def test_kept_columns(spark):
    df = spark.createDataFrame([("k", '{"articles":[{"url":"u"}]}')], "key string, value string")
    assert flatten_articles(df, keep=("key",)).first().asDict()["key"] == "k"


def test_lines(spark):
    df = flat(spark, '{"articles":[{"title":"a\\n b","publishedAt":"2024"},{}]}')
    assert [r.line for r in article_lines(df).collect()] == [
        "Title: a b | Published At: 2024", "Title: No title | Published At: Unknown date",
    ]


def test_messages_are_bounded_and_whole(spark):
    df = spark.range(1000).selectExpr(
        "cast(id as string) as title", "if(id < 900, 'hot', concat('s', id % 7)) as source"
    )
    messages = to_messages(df, ("source",), per_message=10)
    assert "Exchange" not in messages._jdf.queryExecution().executedPlan().toString()
    sizes = [len(json.loads(r.value)["articles"]) for r in messages.collect()]
    assert max(sizes) <= 10 and sum(sizes) == 1000
    assert messages.columns == ["key", "value"] and messages.first().key is None
    back = flatten_articles(messages).select("title")
    assert sorted(r.title for r in back.collect()) == sorted(str(i) for i in range(1000))


def test_messages_are_bounded_in_bytes(spark):
    df = spark.range(300).selectExpr("repeat('é', int(id % 50) * 100) as title", "cast(id as string) as url").coalesce(1)
    values = [r.value for r in to_messages(df, most_bytes=20_000).collect()]
    assert max(len(v.encode()) for v in values) <= 20_000 < 2 * min(sorted(len(v.encode()) for v in values)[1:])
    assert sorted(a["url"] for v in values for a in json.loads(v)["articles"]) == sorted(map(str, range(300)))


def test_an_article_larger_than_a_message_is_alone(spark):
    df = spark.createDataFrame([("a",), ("x" * 5_000,), ("b",)], "title string").coalesce(1)
    sizes = sorted(len(json.loads(r.value)["articles"]) for r in to_messages(df, most_bytes=1_000).collect())
    assert sizes == [1, 1, 1] or sizes == [1, 2]


def test_unreadable_messages_are_counted(spark):
    from pyspark.sql import Observation

    seen = Observation()
    values = ['{"articles":[{}]}', "{bad", None, '{"articles":{}}', '{"articles":[]}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert flatten_articles(df, observe=seen).count() == 1
    assert seen.get == {"messages": 5, "unreadable": 3}


def test_groups_are_not_mixed(spark):
    rows = [("a", None), ("b", "x"), ("c", "y"), ("d", None), ("e", "x")]
    df = spark.createDataFrame(rows, "title string, source string").coalesce(1)
    packed = [[a["title"] for a in json.loads(r.value)["articles"]] for r in to_messages(df, ("source",)).collect()]
    assert sorted(map(sorted, packed)) == [["a", "d"], ["b", "e"], ["c"]]
    whole = to_messages(df).collect()
    assert [len(json.loads(r.value)["articles"]) for r in whole] == [5]
