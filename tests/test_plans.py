import pytest
from pyspark.sql import functions as F

from newsloom.annotators import build_pipeline, news_stages
from newsloom.operators import pos_words, term_tfidf, tokenize
from newsloom.plans import run_batch
from newsloom.plans.batch_trends import batch_results
from newsloom.sources import in_memory


@pytest.fixture
def corpus(texts):
    return texts("Tesla and cars, Tesla.", "Emmanuel Macron drives cars!", "the car")


@pytest.fixture
def lemmas(spark):
    return spark.createDataFrame([("cars", "car")], "token string, lemma string")


def test_batch_job(corpus, lemmas, spark, tmp_path):
    written = {}
    results = run_batch(
        corpus, lambda df, table, mode: written.update({table: (mode, df.collect())}),
        pos_lexicon=pos_words(spark), lemma_lexicon=lemmas, annotated_path=f"{tmp_path}/annotated",
    )
    mode, keywords = written["keyword_counts"]
    assert mode == "overwrite" and [tuple(r) for r in keywords[:2]] == [("car", 3), ("Tesla", 2)]
    mode, entities = written["entity_counts"]
    assert mode == "append" and (entities[0].entity, entities[0]["count"]) == ("Tesla", 2)
    assert results["top_entities"].first().entity == "Tesla"
    assert {r.pos_tag for r in results["pos_frequencies"].collect()} >= {"NNP", "NNS", "CC", "DT"}
    assert {r.df for r in results["tfidf"].where("term = 'car'").collect()} == {3}


def test_batch_results_do_not_depend_on_saving(corpus, lemmas, spark, tmp_path):
    words = spark.createDataFrame([("the",), ("and",)], "word string")
    args = dict(pos_lexicon=pos_words(spark), lemma_lexicon=lemmas, stopwords=words, date="2024-01-01")
    plain, saved = batch_results(corpus, **args), batch_results(corpus, **args, annotated_path=f"{tmp_path}/a")
    for name in plain:
        assert sorted(map(tuple, plain[name].collect())) == sorted(map(tuple, saved[name].collect())), name


def test_saved_results_read_only_their_columns(corpus, lemmas, spark, tmp_path):
    results = batch_results(corpus, pos_words(spark), lemmas, annotated_path=f"{tmp_path}/a")
    plan = results["keyword_counts"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<token:array<string>>" in plan
    plan = results["top_entities"]._jdf.queryExecution().executedPlan().toString()
    assert "metadata" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_pipeline(lemmas, spark):
    vectors = spark.createDataFrame([("Paris", [1.0, 0.0])], "token string, vector array<double>")
    places = spark.createDataFrame([("Paris", "LOC")], "phrase string, entity_type string")
    smoke = in_memory(spark, [("Emmanuel Macron visite Paris in the cars",)])
    model = build_pipeline(news_stages(pos_words(spark), lemmas, vectors, places)).fit(smoke)
    row = model.transform(smoke).selectExpr(
        "token.result as token", "pos.result as pos", "cleanTokens.result as clean", "lemma.result as lemma",
        "word_embeddings", "ner.result as ner", "entities.result as entities", "entities.metadata as metadata",
        "finished_lemma", "features",
    ).first()
    assert row.token == "Emmanuel Macron visite Paris in the cars".split()
    assert row.pos == ["NNP", "NNP", "NN", "NNP", "IN", "DT", "NNS"]
    assert row.clean == ["Emmanuel", "Macron", "visite", "Paris", "cars"]
    assert row.finished_lemma == row.lemma == ["Emmanuel", "Macron", "visite", "Paris", "car"]
    assert row.word_embeddings == [None, None, None, [1.0, 0.0], None, None, None]
    assert row.ner == ["B-MISC", "I-MISC", "O", "B-LOC", "O", "O", "O"]
    assert row.entities == ["Emmanuel Macron", "Paris"]
    assert [m["entity"] for m in row.metadata] == ["MISC", "LOC"]
    assert row.features.size == 1000


def test_no_cross_joins(corpus, spark):
    df = term_tfidf(tokenize(corpus), documents=corpus)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_stages_take_a_table_of_stop_words(lemmas, spark):
    words = spark.createDataFrame([("THE",), ("in",), (None,)], "word string")
    smoke = in_memory(spark, [("Emmanuel in the cars",)])
    model = build_pipeline(news_stages(pos_words(spark), lemmas, stopwords=words)).fit(smoke)
    assert model.transform(smoke).selectExpr("cleanTokens.result as c").first().c == ["Emmanuel", "cars"]
