import random

import numpy as np
import pytest

from newsloom.operators import tag_arrays, tag_in_context, train_context_tagger, train_pos_lexicon


def sentences(n, seed):
    """`run` and `walk` are nouns after `the`, verbs after `they`; the word alone does not tell."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        tokens, tags = [], []
        for _ in range(rng.randint(1, 4)):
            word = rng.choice(["run", "walk", "talk", "look"])
            if rng.random() < 0.5:
                tokens += ["the", word]
                tags += ["DT", "NN"]
            else:
                tokens += ["they", word]
                tags += ["PRP", "VB"]
        rows.append((tokens, tags))
    return rows


@pytest.fixture(scope="module")
def tagger(spark):
    return train_context_tagger(spark.createDataFrame(sentences(200, 1), "token array<string>, tag array<string>"), shards=4)


def test_context_beats_the_lexicon(spark, tagger):
    new = spark.createDataFrame(sentences(100, 2), "token array<string>, tag array<string>")
    rows = tag_in_context(new, tagger).collect()
    assert all(r.pos == r.tag for r in rows)
    pairs = [(t, g) for tokens, tags in sentences(200, 1) for t, g in zip(tokens, tags)]
    lexicon = train_pos_lexicon(spark.createDataFrame(pairs, "token string, tag string"))
    listed = tag_arrays(new, lexicon, "token", "pos").collect()
    assert sum(r.pos != r.tag for r in listed) > 30


def test_any_partitioning_gives_the_same_model(spark, tagger):
    rows = sentences(200, 1)
    random.Random(3).shuffle(rows)
    other = train_context_tagger(spark.createDataFrame(rows, "token array<string>, tag array<string>").repartition(5), shards=4)
    assert other.tags == tagger.tags == ["DT", "NN", "PRP", "VB"]
    assert all(np.array_equal(a, b) for a, b in ((other.words, tagger.words), (other.before, tagger.before), (other.two, tagger.two)))


def test_odd_arrays(spark, tagger):
    df = spark.createDataFrame([(0, None), (1, []), (2, [None, "the", "run"]), (3, ["they"])], "id int, token array<string>")
    found = {r.id: r.pos for r in tag_in_context(df, tagger).collect()}
    assert found[0] is None and found[1] == [] and found[2][1:] == ["DT", "NN"] and found[3] == ["PRP"]


def test_little_to_learn_from(spark):
    df = spark.createDataFrame([(["a", "b"], ["X", None])], "token array<string>, tag array<string>")
    assert tag_in_context(df, train_context_tagger(df)).first().pos == ["X", "X"]
    none = train_context_tagger(df.limit(0))
    assert tag_in_context(df, none).first().pos == [None, None]


def test_all_rows_are_learned_from(spark):
    """More rows than any bound of earlier rounds; each rare tag is in one row."""
    rows = [([f"w{i}", "x"], ["A", "B"]) for i in range(30_000)] + [([f"rare{i}"], [f"T{i}"]) for i in range(8)]
    tagger = train_context_tagger(spark.createDataFrame(rows, "token array<string>, tag array<string>"), epochs=1)
    assert tagger.tags == ["A", "B", *[f"T{i}" for i in range(8)]]


def test_the_query_learns_from_all_documents(monkeypatch, spark, tmp_path):
    """Three quarters of 800 documents, twice the 300 of earlier rounds."""
    import __spark_entry__ as registered

    given = {}
    learn = registered.train_context_tagger
    monkeypatch.setattr(registered, "train_context_tagger", lambda rows, **args: given.update(args, rows=rows.count()) or learn(rows, **args))
    texts = [(i, f"The {'a' if i % 2 else 'b'}{i} ran to 7 men.") for i in range(800)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = registered.q_pos_context(spark, str(tmp_path)).first()
    assert given["rows"] == 600 and given.get("max_rows") is None
    assert row.documents == 200 and row.above_lexicon and row.nearly_all


def test_many_copies_and_more_shards(spark, monkeypatch):
    """Copies of a row count each, and are dealt over the shards; shards follow the tokens."""
    from newsloom.operators import perceptron

    monkeypatch.setattr(perceptron, "_SHARD_TOKENS", 100)
    rows = sentences(200, 1) + [(["they", "run"], ["PRP", "VB"])] * 1000
    df = spark.createDataFrame(rows, "token array<string>, tag array<string>")
    one, two = (train_context_tagger(df.repartition(k), epochs=2) for k in (2, 5))
    assert all(np.array_equal(a, b) for a, b in ((one.words, two.words), (one.before, two.before), (one.two, two.two)))
    new = spark.createDataFrame(sentences(100, 2), "token array<string>, tag array<string>")
    assert all(r.pos == r.tag for r in tag_in_context(new, one).collect())


def test_blocks_learn_as_words_one_by_one():
    """A shard's epoch against the perceptron word by word."""
    import pyarrow as pa

    from newsloom.operators.perceptron import _epoch, _featurer

    size, tags, rng = 1 << 10, 3, np.random.default_rng(4)
    codes, places_of = {"A": 0, "B": 1, "C": 2}, _featurer(size)
    rows = [([str(w) for w in rng.integers(0, 40, k)], [["A", "B", "C", None][int(t)] for t in rng.integers(0, 4, k)]) for k in rng.integers(1, 60, 40)]
    rows[3] = ([None, "x"], ["A", "B"])
    start = tuple(rng.integers(-3, 3, (n, tags)).astype(float) for n in (size, tags + 1, (tags + 1) ** 2))
    now, late, step = [s.copy() for s in start], [np.zeros_like(s) for s in start], 1
    for tokens, gold in rows:
        around, t1, t2 = ["", *tokens, ""], tags, tags
        for i, tag in enumerate(gold):
            places = np.concatenate([places_of([around[i + k]], role)[0] for k, role in enumerate("-0+")])
            at = (places, t1, t2 * (tags + 1) + t1)
            guess, code = int((now[0][places].sum(0) + now[1][t1] + now[2][at[2]]).argmax()), codes.get(tag)
            if code is not None and guess != code:
                for part, l, place in zip(now, late, at):
                    for where, sign in ((code, 1.0), (guess, -1.0)):
                        np.add.at(part, (place, where), sign)
                        np.add.at(l, (place, where), sign * step)
            step, t2, t1 = step + 1, t1, guess
    table = pa.table({
        "tokens": pa.array([r[0] for r in rows], pa.list_(pa.string())), "tags": pa.array([r[1] for r in rows], pa.list_(pa.string())),
        "order": pa.array(range(len(rows))), "times": pa.array([1] * len(rows)),
    })
    out = _epoch(size, tags, start, codes)(table)
    for k in range(3):
        found = start[k].copy().ravel()
        here = out.filter(pa.compute.equal(out.column("part"), k))
        found[here.column("place").to_numpy()] += here.column("weight").to_numpy()
        assert np.array_equal(found.reshape(start[k].shape), now[k])
        mean = start[k].copy().ravel()
        mean[here.column("place").to_numpy()] += here.column("mean").to_numpy()
        assert np.allclose(mean.reshape(start[k].shape), now[k] - late[k] / step)
