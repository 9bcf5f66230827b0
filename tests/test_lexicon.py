import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import (
    drop_stopwords, embed, finish, keyword_counts, lemma_arrays, lemmatize, pos_frequencies, pos_tag, pos_words,
    remove_stopwords, tag_arrays, token_counts, token_rows, tokenize, train_pos_lexicon, vector_arrays,
)
from newsloom.operators.lexicon import even_join, fits, lookup, normalize_lexicon


@pytest.fixture
def corpus(texts):
    rng = random.Random(3)
    words = ["the", "The", "cars", "car", "Paris", "running", "slowly", "42nd", "famous", "of", "xyz"]
    rows = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(40)]
    return tokenize(texts(*rows, rows[0], rows[0]))


@pytest.fixture
def lemmas(spark):
    return spark.createDataFrame([("cars", "car"), ("running", "run")], "token string, lemma string")


def test_tokens(texts):
    df = tokenize(texts("  a b\tc ", "", "d"))
    assert [r.token for r in df.orderBy("doc_id").collect()] == [["a", "b", "c"], [], ["d"]]
    assert [tuple(r) for r in token_rows(df).orderBy("doc_id", "pos").collect()] == [
        (0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (2, 0, "d"),
    ]


def test_stop_words_ignore_case(texts, spark):
    df = tokenize(texts("The cat AND I"))
    assert remove_stopwords(df).first().cleanTokens == ["cat"]
    table = spark.createDataFrame([("the",), ("The",), ("and",)], "word string")
    assert [r.token for r in drop_stopwords(token_rows(df), table).orderBy("pos").collect()] == ["cat", "I"]


@pytest.mark.parametrize("token, tag", [
    ("the", "DT"), ("The", "DT"), ("of", "IN"), ("42nd", "CD"), ("Paris", "NNP"), ("slowly", "RB"),
    ("running", "VBG"), ("walked", "VBD"), ("famous", "JJ"), ("cars", "NNS"), ("car", "NN"),
])
def test_pos_tags(spark, token, tag):
    df = spark.createDataFrame([(token,)], "token string")
    assert pos_tag(df, pos_words(spark)).first().pos_tag == tag


@pytest.mark.parametrize("carry", [1000, 0])
def test_arrays_agree_with_rows(corpus, lemmas, spark, carry):
    for arrays, rows, value, lexicon in [
        (tag_arrays, pos_tag, "pos_tag", pos_words(spark)), (lemma_arrays, lemmatize, "lemma", lemmas),
    ]:
        in_arrays = arrays(corpus, lexicon, out="found", carry_rows=carry)
        assert in_arrays.count() == corpus.count()
        assert in_arrays.where(F.size("found") != F.size("token")).count() == 0
        got = in_arrays.select("doc_id", F.posexplode("found")).collect()
        expected = rows(token_rows(corpus), lexicon).select("doc_id", "pos", value).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


@pytest.mark.parametrize("carry", [1000, 0])
def test_vectors(corpus, spark, carry):
    vectors = spark.createDataFrame([("car", [1.0, 2.0]), ("the", [3.0, 4.0])], "token string, vector array<double>")
    rows = {r.token: r.vector for r in embed(token_rows(corpus), vectors).collect()}
    assert rows["car"] == [1.0, 2.0] and rows["The"] is None
    for r in vector_arrays(corpus, vectors, carry_rows=carry).collect():
        assert r.word_embeddings == [rows[t] for t in r.token]


def test_large_lexicon_is_merged_but_for_hot_keys(corpus, lemmas):
    rows = token_rows(corpus)
    rows = rows.unionByName(rows.limit(3).withColumn("token", F.lit(None).cast("string")))
    entries = lemmas.select("token", "lemma")
    columns = ["doc_id", "pos", "token", "lemma"]
    for how in ("left", "inner"):
        plain = sorted(map(tuple, rows.join(entries, "token", how).select(*columns).collect()), key=repr)
        for shares in (1, 3, 50):
            joined = even_join(rows, entries, "token", how, shares=shares)
            assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, joined.select(*columns).collect()), key=repr) == plain
        by_lookup = lookup(rows, entries, "token", how, broadcast_rows=0).select(*columns)
        assert sorted(map(tuple, by_lookup.collect()), key=repr) == plain


def test_size_is_rows_and_bytes(spark):
    table = spark.range(100).selectExpr("cast(id as string) as token", "repeat('x', 1000) as lemma")
    assert fits(table, 100) and not fits(table, 99) and not fits(table, 0)
    assert not fits(table, 100, most_bytes=50_000)


def test_one_row_per_token(spark):
    lexicon = spark.createDataFrame(
        [("cars", "car"), ("cars", "auto"), ("Cars", "x"), (None, "y"), ("z", None)], "token string, lemma string"
    )
    assert sorted(map(tuple, normalize_lexicon(lexicon, "lemma").collect())) == [("Cars", "x"), ("cars", "auto")]
    assert sorted(map(tuple, normalize_lexicon(lexicon, "lemma", fold=True).collect())) == [("cars", "auto")]


ODD = [(0, ["cars", "and", "cars"]), (1, None), (2, []), (3, ["a b"]), (4, ["a", "b"]), (5, ["Paris", "PARIS", None]), (6, ["cars", "and", "cars"])]


@pytest.mark.parametrize("carry", [1000, 0])
def test_all_ways_agree_on_odd_input(spark, carry):
    """Repeated keys, mixed case, nulls and tokens with blanks: rows, carried and joined."""
    df = spark.createDataFrame(ODD, "doc_id long, token array<string>")
    lemmas = spark.createDataFrame([("cars", "car"), ("cars", "auto"), ("a b", "ab"), ("a", "A")], "token string, lemma string")
    tags = spark.createDataFrame([("Paris", "NNP"), ("paris", "ZZ"), ("a b", "X"), ("b", "Y")], "token string, tag string")
    got = {r.doc_id: r.lemma for r in lemma_arrays(df, lemmas, carry_rows=carry).collect()}
    assert got == {
        0: ["auto", "and", "auto"], 1: None, 2: [], 3: ["ab"], 4: ["A", "b"], 5: ["Paris", "PARIS", None], 6: ["auto", "and", "auto"],
    }
    got = {r.doc_id: r.pos for r in tag_arrays(df, tags, carry_rows=carry).collect()}
    assert got[3] == ["X"] and got[4] == ["NN", "Y"] and got[5][:2] == ["NNP", "NNP"] and got[1] is None and got[2] == []
    known = df.where("token is not null")
    rows = lemmatize(token_rows(known), lemmas, broadcast_rows=carry).select("doc_id", "pos", "lemma").collect()
    arrays = lemma_arrays(known, lemmas, carry_rows=carry).select("doc_id", F.posexplode("lemma")).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, arrays), key=repr)


def test_repeated_keys_do_not_change_counts(spark, texts):
    corpus = tokenize(texts("cars Paris cars"))
    lemmas = spark.createDataFrame([("cars", "car"), ("cars", "auto")], "token string, lemma string")
    assert {r.word: r["count"] for r in keyword_counts(corpus, lemmas).collect()} == {"auto": 2, "Paris": 1}
    tags = spark.createDataFrame([("cars", "NNS"), ("cars", "VBZ"), ("Paris", "LOC")], "token string, tag string")
    assert {r.pos_tag: r["count"] for r in pos_frequencies(corpus, tags).collect()} == {"NNS": 2, "LOC": 1}


@pytest.mark.parametrize("carry", [200_000, 0])
def test_stop_words_of_a_table(spark, texts, carry, monkeypatch):
    monkeypatch.setattr("newsloom.operators.lexicon.look_up_arrays.__defaults__", (carry, False))
    df = tokenize(texts("The cat AND I", "", "the"))
    table = spark.createDataFrame([("the",), ("The",), ("and",), (None,)], "word string")
    assert [r.cleanTokens for r in remove_stopwords(df, table).orderBy("doc_id").collect()] == [["cat", "I"], [], []]


def test_trained_lexicon(spark):
    tagged = spark.createDataFrame([("a", "X"), ("a", "Y"), ("a", "Y"), ("b", "Z"), ("b", "Y")], "token string, tag string")
    assert sorted(map(tuple, train_pos_lexicon(tagged).collect())) == [("a", "Y"), ("b", "Y")]


def test_keywords(corpus, lemmas, spark):
    words = [t for r in corpus.collect() for t in r.token if t.lower() not in ("the", "of")]
    base = {"cars": "car", "running": "run"}
    expected = {}
    for word in words:
        expected[base.get(word, word)] = expected.get(base.get(word, word), 0) + 1
    ranked = sorted(expected.items(), key=lambda e: (-e[1], e[0]))
    assert [tuple(r) for r in keyword_counts(corpus, lemmas).collect()] == ranked
    assert [tuple(r) for r in keyword_counts(corpus, lemmas, k=3).collect()] == ranked[:3]
    table = spark.createDataFrame([("the",), ("OF",)], "word string")
    assert [tuple(r) for r in keyword_counts(corpus, lemmas, table).collect()] == ranked


def test_short_keywords_are_left_out(texts):
    assert [r.word for r in keyword_counts(tokenize(texts("x yy é")), stopwords=["none"]).collect()] == ["yy"]


def test_pos_frequencies_agree_with_tags(corpus, spark):
    tagged = pos_tag(token_rows(corpus), pos_words(spark)).groupBy("pos_tag").count()
    expected = sorted(map(tuple, tagged.collect()), key=lambda e: (-e[1], e[0]))
    assert [tuple(r) for r in pos_frequencies(corpus, pos_words(spark)).collect()] == expected[:20]


def test_token_counts_combine_before_the_shuffle(corpus):
    plan = token_counts(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_finish(spark):
    df = spark.sql("select array(named_struct('result', 'a', 'metadata', map('k', 'v'))) as lemma")
    assert finish(df).first().finished_lemma == ["a"]
