"""Steps whose work must grow with the input: what their plans hold, and that results stay."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as registered
from newsloom.operators import chunk_spans, lemma_arrays, ner_tag, texts_at, token_spans, vector_arrays
from newsloom.operators.lexicon import _joined
from newsloom.operators.tagger import features, where_true


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_do_not_search_the_text_from_its_begin(spark):
    text = "Äpfel aus Bad Tölz 🍎 und Ulm, " * 300
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    spans = token_spans(df)
    found = chunk_spans(ner_tag(spans.withColumn("token", F.col("spans.token")), None))
    assert "substring(text" not in plan(found)
    rows = {r["doc_id"]: r["chunks"] for r in found.collect()}
    assert len(rows[1]) > 600 and all(text[c["begin"]:c["end"]] == c["result"] for c in rows[1])
    assert rows[2] is None and rows[3] == []


def test_parts_of_a_text(spark):
    df = spark.createDataFrame([("a🍎bc", [0, 1], [2, 9]), (None, [0], [1]), ("x", None, None)], "t string, b array<int>, e array<int>")
    assert [r["p"] for r in texts_at(df, "t", "b", "e", "p").collect()] == [["a🍎", "🍎bc"], None, None]


def test_embedded_dimensions_are_summed_once_a_batch(spark, tmp_path):
    spark.createDataFrame([(i, f"word{i % 3} tail word1") for i in range(9)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [(i, [0.0000005 * (i - 2), -0.25 * i, 3.0]) for i in range(5)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = registered.q_token_embeddings(spark, str(tmp_path))
    assert "zip_with" not in plan(found)
    import numpy as np
    from hashlib import md5

    def value(word):
        v = [float(np.float32(x)) * 1e6 for x in vectors[int(md5(word.encode()).hexdigest()[:6], 16) % 5][1]]
        return sum((int(abs(x) + 0.5) * (1 if x > 0 else -1)) * (i + 1) for i, x in enumerate(v))

    rows = {r["doc_id"]: (r["tokens"], r["known"], r["all_dimensions"]) for r in found.collect()}
    assert rows == {i: (3, 3, sum(map(value, (f"word{i % 3}", "tail", "word1")))) for i in range(9)}


def test_features_of_some_tokens_are_those_of_all(spark):
    df = spark.createDataFrame([(["Ulm", None, "x9", "Bad", "Tölz"],)], "token array<string>")
    df = df.withColumn("at", where_true(F.transform("token", lambda t: t.rlike("^[A-Z]"))))
    row = df.select("at", features("token", 512).alias("every"), features("token", 512, "at").alias("some")).first()
    assert row["at"] == [0, 3, 4]
    assert row["some"] == [p for i in row["at"] for p in row["every"][9 * i:9 * i + 9]]


def test_large_lexicons_join_different_tokens(spark):
    draw = random.Random(3)
    rows = [(i, [draw.choice(["a", "b", "C", "", None, "ä"]) for _ in range(draw.randrange(40))]) for i in range(30)]
    rows += [(50, None), (51, []), (52, rows[3][1]), (53, [None])]
    df = spark.createDataFrame(rows, "doc_id long, token array<string>").repartition(3)
    lexicon = spark.createDataFrame([("a", "x"), ("ä", "y"), ("", "z")], "token string, lemma string")
    shown = lambda out: sorted(map(str, out.select("doc_id", out.columns[-1]).collect()))
    assert shown(lemma_arrays(df, lexicon, carry_rows=0)) == shown(lemma_arrays(df, lexicon))
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("ä", [3.0, 4.0])], "token string, vector array<float>")
    assert shown(vector_arrays(df, vectors, carry_rows=0)) == shown(vector_arrays(df, vectors))
    entries = lexicon.select(F.col("token").alias("_token"), F.col("lemma").alias("_value"))
    assert "array_distinct" in plan(_joined(df, entries, "token", "out"))
