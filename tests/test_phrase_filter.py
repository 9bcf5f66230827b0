"""Gazetteers too large to travel: the filter, and the same tags as with the trie."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import match_phrases, phrase_filter as module, phrases, prepare_gazetteer


def tags(df):
    return sorted(map(str, df.select("doc_id", "ner").collect()))


@pytest.fixture
def corpus(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice("abcdef") for _ in range(draw.randrange(60))]) for i in range(60)]
    rows += [(100, None), (101, []), (102, ["a", None, "b"]), (103, ["a b", "c"]), *[(200 + i, rows[7][1]) for i in range(3)]]
    return spark.createDataFrame(rows, "doc_id long, token array<string>").repartition(3)


@pytest.fixture
def gazetteer(spark):
    draw = random.Random(6)
    found = {" ".join(draw.choice("abcdef") for _ in range(draw.randrange(1, 6))) for _ in range(80)}
    return spark.createDataFrame([(p, "XYZ"[len(p) % 3]) for p in sorted(found)], "phrase string, entity_type string")


@pytest.mark.parametrize("largest", [module.LARGEST, 0])
def test_joined_tags_are_those_of_the_trie(corpus, gazetteer, monkeypatch, largest):
    """With the filter of all phrases, and with that of phrases whose words are all in the corpus."""
    monkeypatch.setattr(phrases, "LARGEST", largest)
    unknown = gazetteer.select(F.concat("phrase", F.lit(" zz")).alias("phrase"), "entity_type")
    both = gazetteer.unionByName(unknown)
    assert tags(match_phrases(corpus, both, carry_phrases=0)) == tags(match_phrases(corpus, both))


def test_a_long_phrase_makes_no_long_windows(spark):
    """What is joined grows with the matches, not with the length of the longest phrase."""
    words = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(1, words), (2, words[1:]), (3, ["w0", "w1"] * 900)], "doc_id long, token array<string>")
    table = spark.createDataFrame([(" ".join(words), "ALL"), ("w0 w1", "TWO")], "phrase string, entity_type string")
    ready = prepare_gazetteer(table, carry_phrases=0)
    runs = module.candidates(ready.sieve)(df.select("token").toArrow().column(0).combine_chunks()).to_pylist()
    assert {"pos": 0, "n": 3000} in runs[0] and sum(map(len, runs)) < 1000 + 100
    found = {r["doc_id"]: r["ner"] for r in match_phrases(df, ready).collect()}
    assert found[1] == ["B-ALL"] + ["I-ALL"] * 2999 and found[2] == ["O"] * 2999 and found[3] == ["B-TWO", "I-TWO"] * 900


def test_filter_size_is_bounded():
    assert [module.filter_words(n) for n in (0, 1 << 20, 1 << 60)] == [module.LEAST_WORDS, 1 << 18, module.MOST_WORDS]


def test_all_phrases_pass(spark):
    table = spark.createDataFrame([(f"x{i} y{i}",) for i in range(500)], "phrase string")
    sieve = module.phrase_filter(table, 1000)
    tokens = spark.createDataFrame([([f"x{i}", f"y{i}", "z"],) for i in range(500)], "token array<string>").toArrow().column(0).combine_chunks()
    runs = module.candidates(sieve)(tokens).to_pylist()
    assert all({"pos": 0, "n": 2} in run for run in runs) and sum(map(len, runs)) < 600 and isinstance(sieve, np.ndarray)
