from newsloom.operators import guess_lemmas, train_lemma_rules

PAIRS = [
    ("cities", "city"), ("ladies", "lady"), ("parties", "party"), ("stories", "story"), ("cars", "car"), ("dogs", "dog"),
    ("trees", "tree"), ("walked", "walk"), ("talked", "talk"), ("bus", "bus"), ("gas", "gas"), ("glass", "glass"),
    ("grass", "grass"), ("went", "go"), ("tables", "table"), ("houses", "house"),
]


def lexicon(spark, pairs=PAIRS):
    return spark.createDataFrame(pairs, "token string, lemma string")


def test_held_out_lemmas(spark):
    """The longest ending counts: `ies` over `s`, `ss` stays."""
    words = spark.createDataFrame([(w,) for w in ["berries", "hats", "jumped", "class", "s", "", None, "cars", "hats"]], "token string")
    found = {r.token: r.lemma for r in guess_lemmas(words, train_lemma_rules(lexicon(spark)), lexicon(spark)).collect()}
    assert found == {"berries": "berry", "hats": "hat", "jumped": "jump", "class": "class", "s": "s"}
    joined = guess_lemmas(words, train_lemma_rules(lexicon(spark)), lexicon(spark), broadcast_rows=0)
    assert {r.token: r.lemma for r in joined.collect()} == found


def test_ties_and_rare_endings(spark):
    rules = train_lemma_rules(lexicon(spark, [("ax", "a"), ("bx", "b"), ("cx", "cx"), ("dx", "dx"), ("ey", "e")]))
    assert {r.ending: (r.strip, r["add"]) for r in rules.collect()} == {"x": (0, ""), "": (0, "")}


def test_nothing_to_learn_from(spark):
    none = lexicon(spark, [])
    words = spark.createDataFrame([("cars",)], "token string")
    assert guess_lemmas(words, train_lemma_rules(none)).collect() == []
