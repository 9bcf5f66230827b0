import math

from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from newsloom.operators import remove_stopwords, term_frequencies, term_tfidf, tfidf, tokenize


def terms(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, token array<string>")


def test_golden_weights(spark):
    df = terms(spark, ["a", "b", "a"], ["b", "c"])
    got = {(r.doc_id, r.term): round(r.tfidf, 4) for r in term_tfidf(df).collect()}
    assert got == {(0, "a"): 0.8109, (0, "b"): 0.0, (1, "b"): 0.0, (1, "c"): 0.4055}


def test_empty_documents_count(spark):
    row = term_tfidf(terms(spark, ["a"], [], [])).first()
    assert math.isclose(row.tfidf, math.log(4 / 2)) and row.df == 1 and row.tf == 1


def test_term_frequencies(spark):
    df = terms(spark, ["b", "a", "b", "é", "B"], [], ["x"])
    assert sorted(map(tuple, term_frequencies(df).collect())) == [
        (0, "B", 1), (0, "a", 1), (0, "b", 2), (0, "é", 1), (2, "x", 1),
    ]


def test_shares_change_nothing(texts):
    df = tokenize(texts(*(f"hot w{i % 5} x{i}" for i in range(50))))
    plain = sorted(map(tuple, term_tfidf(df, shares=1).collect()))
    for shares in (2, 5, 1000):
        assert sorted(map(tuple, term_tfidf(df, shares=shares).collect())) == plain


def test_only_frequent_terms_are_broadcast(texts):
    df = tokenize(texts(*(f"hot x{i}" for i in range(50))))
    plan = term_tfidf(df, shares=4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") <= 2 and "Generate explode(sequence" not in plan


def test_lemmas_and_stop_words(spark):
    df = terms(spark, ["cars", "car", "the"], ["car"])
    lexicon = spark.createDataFrame([("cars", "car")], "token string, lemma string")
    stop = spark.createDataFrame([("the",)], "word string")
    got = sorted((r.doc_id, r.term, r.tf, r.df) for r in term_tfidf(df, lexicon=lexicon, stopwords=stop).collect())
    assert got == [(0, "car", 2, 2), (1, "car", 1, 2)]


def test_hashed_features_follow_the_formula(texts):
    """Hashed features against counts made per bucket."""
    df = remove_stopwords(tokenize(texts("a red car", "red red bus", "blue car", "")))
    bucket = HashingTF(numFeatures=1000, inputCol="cleanTokens").indexOf
    documents = {r.doc_id: r.cleanTokens for r in df.collect()}
    in_documents = {}
    for words in documents.values():
        for b in {bucket(w) for w in words}:
            in_documents[b] = in_documents.get(b, 0) + 1
    for row in tfidf(df, "cleanTokens").collect():
        expected = {}
        for word in documents[row.doc_id]:
            b = bucket(word)
            expected[b] = expected.get(b, 0) + math.log((len(documents) + 1) / (in_documents[b] + 1))
        assert row.features.size == 1000
        got = dict(zip(row.features.indices.tolist(), row.features.values.tolist()))
        assert {b: round(v, 9) for b, v in got.items()} == {b: round(v, 9) for b, v in expected.items()}
