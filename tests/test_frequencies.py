import random

from newsloom.operators import frequency_changes, merge_frequencies, term_tfidf, weigh_terms
from newsloom.sinks import batch_table, read_batches
from newsloom.streaming import frequency_query

SCHEMA = "doc_id long, token array<string>"


def table(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.collect()), key=repr)


def test_any_sequence_equals_a_fresh_fit(spark):
    """Documents come, go and change; every table of frequencies is that of the documents then there."""
    rng, live, changes = random.Random(3), {}, []
    for step in range(4):
        moves = []
        for _ in range(30):
            i = rng.randrange(25)
            if i in live:
                moves.append((i, live.pop(i), -1))
            if rng.random() < 0.7:
                live[i] = [rng.choice("abcdefgé") for _ in range(rng.randrange(6))]
                moves.append((i, live[i], 1))
        changes.append(frequency_changes(spark.createDataFrame(moves, SCHEMA + ", change int"), "token", "change"))
    merged = merge_frequencies(*changes)
    docs = spark.createDataFrame(list(live.items()), SCHEMA)
    assert table(merged) == table(frequency_changes(docs))
    assert table(weigh_terms(docs, merged)) == table(term_tfidf(docs))
    assert table(weigh_terms(docs, merged, shares=20)) == table(term_tfidf(docs))  # with hot terms


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, ["a", None, "a"]), (2, None), (3, []), (None, ["a"])], SCHEMA)
    assert table(frequency_changes(docs)) == [("a", 2), (None, 4)]
    assert frequency_changes(docs.limit(0)).collect() == []
    new = spark.createDataFrame([(9, ["b", "a"])], SCHEMA)
    found = {r.term: (r.df, round(r.tfidf, 4)) for r in weigh_terms(new, frequency_changes(docs)).collect()}
    assert found == {"a": (2, 0.5108), "b": (0, 1.6094)}  # ln(5/3), ln(5/1)


def test_stream_of_changes_and_a_repeated_batch(spark, tmp_path):
    first = [(1, ["a", "b"], 1), (2, ["a"], 1)]
    second = [(1, ["a", "b"], -1), (1, ["c"], 1)]
    schema = SCHEMA + ", change int"
    sink = batch_table(f"{tmp_path}/out")
    for i, rows in enumerate((first, second)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        frequency_query(stream, sink, f"{tmp_path}/checkpoint", None, change_col="change").awaitTermination()
    sink(frequency_changes(spark.createDataFrame(second, schema), "token", "change"), 1)  # after a failure
    assert table(merge_frequencies(read_batches(spark, f"{tmp_path}/out"))) == [("a", 1), ("c", 1), (None, 2)]
