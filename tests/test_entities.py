import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import (
    annotate_entities, entity_counts, entity_type_counts, extract_entities, iob_to_chunks, match_phrases,
    trending_entities,
)


def chunks(spark, *pairs):
    tokens, tags = [p.rsplit("/", 1)[0] for p in pairs], [p.rsplit("/", 1)[1] for p in pairs]
    df = spark.createDataFrame([(tokens, tags)], "token array<string>, ner array<string>")
    return [(c.result, c.metadata["entity"]) for c in iob_to_chunks(df).first().entities]


def test_iob_chunks(spark):
    found = chunks(
        spark, "Elon/B-PER", "Musk/I-PER", "runs/O", "Tesla/B-ORG", "SpaceX/B-ORG", "New/I-LOC", "York/I-LOC"
    )
    assert found == [("Elon Musk", "PER"), ("Tesla", "ORG"), ("SpaceX", "ORG"), ("New York", "LOC")]


@pytest.mark.parametrize("pairs, found", [
    (["a/O"], []),
    (["a/B-X"], [("a", "X")]),
    (["a/I-X", "b/I-X", "c/I-Y"], [("a b", "X"), ("c", "Y")]),
    (["a/B-X", "b/B-X", "c/O", "d/I-X"], [("a", "X"), ("b", "X"), ("d", "X")]),
])
def test_iob_edges(spark, pairs, found):
    assert chunks(spark, *pairs) == found


def test_iob_no_tokens(spark):
    df = spark.createDataFrame([([], [])], "token array<string>, ner array<string>")
    assert iob_to_chunks(df).first().entities == []


def gazetteer(spark, *pairs):
    return spark.createDataFrame(list(pairs), "phrase string, entity_type string")


def brute_force(tokens, phrases):
    tags, i = [], 0
    words = {tuple(phrase.split(" ")): kind for phrase, kind in phrases.items()}
    while i < len(tokens):
        length = next((n for n in range(9, 0, -1) if i + n <= len(tokens) and tuple(tokens[i:i + n]) in words), 0)
        kind = words.get(tuple(tokens[i:i + length]))
        tags += ["O"] if not length else [f"B-{kind}"] + [f"I-{kind}"] * (length - 1)
        i += max(length, 1)
    return tags


@pytest.mark.parametrize("carry", [1000, 0])
def test_phrases_against_brute_force(spark, carry):
    rng = random.Random(7)
    words = ["a", "b", "c", "d", "e.", "(f)"]
    phrases = {" ".join(rng.choices(words, k=rng.randint(1, 4))): f"T{rng.randrange(20)}" for _ in range(30)}
    rows = [(i, rng.choices(words, k=rng.randint(0, 40))) for i in range(60)]
    rows += [(99, rows[3][1]), (99, rows[3][1])]  # copies, also of the id
    rows += [(100, ["a b"]), (101, ["a", "b"]), (102, ["x", "a b", "c"])]  # a blank inside a token
    phrases |= {"a b": "PAIR", "a b c": "THREE"}
    df = spark.createDataFrame(rows, "doc_id long, token array<string>")
    tagged = match_phrases(df, gazetteer(spark, *phrases.items()), carry_phrases=carry)
    got = sorted((r.doc_id, r.token, r.ner) for r in tagged.collect())
    assert got == sorted((i, t, brute_force(t, phrases)) for i, t in rows)


def test_thousands_of_types_are_no_part_of_the_plan(spark):
    phrases = [(f"w{i} x", f"TYPE{i}") for i in range(3_000)]
    df = spark.createDataFrame([(1, ["w7", "x", "y", "w2999", "x"])], "doc_id long, token array<string>")
    for carry in (10_000, 0):
        tagged = match_phrases(df, gazetteer(spark, *phrases), carry_phrases=carry)
        assert tagged.first().ner == ["B-TYPE7", "I-TYPE7", "O", "B-TYPE2999", "I-TYPE2999"]
        assert "TYPE7" not in tagged._jdf.queryExecution().optimizedPlan().toString()


def test_null_tokens_get_null_tags(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a"])], "doc_id long, token array<string>")
    for carry in (10, 0):
        tagged = match_phrases(df, gazetteer(spark, ("a", "X")), carry_phrases=carry)
        assert {r.doc_id: r.ner for r in tagged.collect()} == {1: None, 2: [], 3: ["B-X"]}


def test_longest_phrase_wins(texts, spark):
    places = gazetteer(spark, ("New York", "LOC"), ("York City", "ORG"), ("New  York City", "LOC"))
    df = annotate_entities(texts("a New York City b New York"), "text", places, names=False)
    assert [c.result for c in df.first().entities] == ["New York City", "New York"]


def test_empty_gazetteer(texts, spark):
    df = annotate_entities(texts("x Y"), "text", gazetteer(spark, ("", "LOC")))
    assert [c.result for c in df.first().entities] == ["Y"]


def test_names_beside_phrases(texts, spark):
    df = annotate_entities(texts("The Élysée palace of Jean-Luc O'Neil in Paris, Texas"), "text",
                           gazetteer(spark, ("Paris", "LOC")))
    assert [(c.result, c.metadata["entity"]) for c in df.first().entities] == [
        ("Élysée", "MISC"), ("Jean-Luc O'Neil", "MISC"), ("Paris", "LOC"), ("Texas", "MISC"),
    ]


def test_extracted_rows(texts, spark):
    as_of = dt.datetime(2024, 1, 1)
    rows = extract_entities(texts("Tesla and X", "nothing"), "text", as_of=as_of).collect()
    assert [r.asDict() for r in rows] == [{
        "entity_name": "Tesla", "entity_type": "MISC", "detected_at": as_of, "source": "CLI_Stream",
        "confidence": 0.8, "frequency": 1,
    }]


def test_counts(texts):
    df = annotate_entities(texts("Tesla or Apple", "Tesla"), "text")
    assert [tuple(r) for r in entity_counts(df).collect()] == [("Tesla", 2), ("Apple", 1)]
    assert entity_counts(df, 1).count() == 1
    typed = entity_type_counts(df, dt.date(2024, 1, 2))
    assert [tuple(r) for r in typed.collect()][0] == ("Tesla", "MISC", 2, dt.date(2024, 1, 2))
    assert typed.columns == ["entity", "entity_type", "count", "date_recorded"]


def test_trending(spark):
    now = dt.datetime(2024, 1, 1, 12)
    ago = lambda s: now - dt.timedelta(seconds=s)
    rows = [("a", "PER", ago(600)), ("a", "PER", ago(601)), ("b", "PER", ago(1)), ("b", "PER", ago(2))]
    rows += [(f"z{i:02}", "LOC", ago(5)) for i in range(30)]
    top = trending_entities(spark.createDataFrame(rows, "entity_name string, entity_type string, detected_at timestamp"), now)
    got = top.collect()
    assert len(got) == 20 and [r.entity_name for r in got[:3]] == ["b", "a", "z00"]
    assert (got[0]["count"], got[0].trend_score, got[1]["count"]) == (2, 3.0, 1)
    assert top.columns == [
        "entity_name", "entity_type", "count", "trend_score", "time_window", "window_duration", "source",
    ]


def test_long_documents_take_linear_time(spark):
    """A plan that runs a column per array element takes minutes here."""
    df = spark.range(8).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Alpha beta Gamma Delta "), 20_000).alias("text"))
    annotated = annotate_entities(df, "text").where(F.size("entities") > 0)
    # "Alpha", then "Gamma Delta Alpha" 19,999 times, then "Gamma Delta"
    assert annotated.agg(F.sum(F.size("entities"))).first()[0] == 8 * 20_001
