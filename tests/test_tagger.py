import random

from newsloom.operators import annotate_entities, match_phrases, ner_tag, tokenize, train_entity_tagger, typed_names

FIRST = ["Anna", "Berta", "Carla", "Dora", "Emma", "Frida", "Gerda", "Hanna", "Irma", "Julia"]
PLACES = ["Altstadt", "Neustadt", "Bergstadt", "Seestadt", "Waldstadt", "Hofstadt", "Feldstadt", "Marktstadt"]


def corpus(texts):
    rng = random.Random(6)
    people = FIRST + ["Nora", "Olga", "Petra", "Rosa"]
    places = PLACES + ["Rheinstadt", "Moorstadt", "Kleinstadt"]
    return texts(*[f"then {rng.choice(people)} went to {rng.choice(places)} again" for _ in range(400)])


def gazetteer(spark):
    rows = [(p, "PER") for p in FIRST] + [(p, "LOC") for p in PLACES]
    return spark.createDataFrame(rows, "phrase string, entity_type string")


def test_unknown_names_get_types_from_ending_and_neighbours(spark, texts):
    docs = corpus(texts)
    tagger = train_entity_tagger(tokenize(docs), gazetteer(spark))
    assert tagger.types == ["LOC", "PER"]
    known = [r.ner for r in annotate_entities(docs, "text", gazetteer(spark), tagger=tagger).collect()]
    assert all(tags == ["O", "B-PER", "O", "O", "B-LOC", "O"] for tags in known)
    new = texts("then Zita went to Hochstadt again", "Paula went to Querstadt then", "", "no names")
    tags = [r.ner for r in annotate_entities(new, "text", gazetteer(spark), tagger=tagger).orderBy("doc_id").collect()]
    assert tags == [["O", "B-PER", "O", "O", "B-LOC", "O"], ["B-PER", "O", "O", "B-LOC", "O"], [], ["O", "O"]]


def test_same_corpus_same_model(spark, texts):
    tokens = tokenize(corpus(texts))
    one, two = (train_entity_tagger(tokens.repartition(n), gazetteer(spark), max_rows=300) for n in (2, 5))
    assert one.types == two.types and abs(one.weights - two.weights).max() < 1e-9


def test_neighbours_of_one_type_are_one_entity(spark, texts):
    tagger = train_entity_tagger(tokenize(corpus(texts)), gazetteer(spark))
    df = ner_tag(tokenize(texts("then Zita Paula went")), gazetteer(spark), names=False)
    assert typed_names(df, tagger).first().ner == ["O", "B-PER", "I-PER", "O"]


def test_a_gazetteer_of_one_type(spark, texts):
    places = spark.createDataFrame([("Altstadt", "LOC")], "phrase string, entity_type string")
    tokens = tokenize(texts("to Altstadt or Bonn"))
    tagger = train_entity_tagger(tokens, places)
    assert typed_names(match_phrases(tokens, places), tagger).first().ner == ["O", "B-LOC", "O", "B-LOC"]


def test_nothing_to_learn_from(spark, texts):
    none = spark.createDataFrame([], "phrase string, entity_type string")
    tokens = tokenize(texts("to Bonn"))
    tagger = train_entity_tagger(tokens, none)
    assert typed_names(match_phrases(tokens, none), tagger).first().ner == ["O", "O"]


def test_decoding_is_the_best_legal_sequence(spark):
    """Every legal sequence of a short run, scored one by one."""
    import itertools
    import math

    import numpy as np
    from pyspark.sql import functions as F

    from newsloom.operators.tagger import EntityTagger, features

    rng = np.random.default_rng(5)
    types, size = ["LOC", "ORG", "PER"], 64
    moves = np.log(rng.dirichlet(np.ones(4), 3))
    tagger = EntityTagger(types, rng.normal(0, 1, (size, 3)), rng.normal(0, 1, 3), moves)
    rows = [["Ab", "Cde", "Fgh", "Ijk"], ["x", "Lm", "Nq"], ["Pq", "x", "Rs", "Tu", "Vw"], [], ["y"], ["Zz"]]
    df = spark.createDataFrame([(i, r, ["O"] * len(r)) for i, r in enumerate(rows)], "id int, token array<string>, ner array<string>").coalesce(1)
    found = {r.id: r.ner for r in typed_names(df, tagger).collect()}
    places = {r.id: r.p for r in df.select("id", features("token", size).alias("p")).collect()}

    def best(likely):
        def score(kinds, on):
            total = likely[0][kinds[0]] - math.log(3)
            for i in range(1, len(kinds)):
                total += moves[kinds[i - 1]][0 if on[i] else 1 + kinds[i]] + likely[i][kinds[i]]
            return total

        every = [
            (kinds, (False, *on)) for kinds in itertools.product(range(3), repeat=len(likely))
            for on in itertools.product([False, True], repeat=len(likely) - 1)
            if all(not o or kinds[i] == kinds[i + 1] for i, o in enumerate(on))
        ]
        kinds, on = max(every, key=lambda one: score(*one))
        return [f"{'I' if o else 'B'}-{types[k]}" for k, o in zip(kinds, on)]

    for i, tokens in enumerate(rows):
        scores = tagger.weights[np.array(places[i], int).reshape(-1, 9)].sum(1) + tagger.bias if tokens else np.zeros((0, 3))
        likely = scores - np.log(np.exp(scores).sum(1, keepdims=True))
        want, j = [], 0
        while j < len(tokens):
            end = j
            while end < len(tokens) and tokens[end][0].isupper():
                end += 1
            want += best(likely[j:end]) if end > j else ["O"]
            j = max(end, j + 1)
        assert found[i] == want


def test_phrases_of_several_words_go_on(spark, texts):
    docs = texts(*[f"saw {a} {b} there" for a in ("Anna", "Berta", "Carla") for b in ("Meier", "Huber", "Bauer")] * 3)
    phrases = [(f"{a} {b}", "PER") for a in ("Anna", "Berta") for b in ("Meier", "Huber")] + [("Carla", "LOC")]
    tagger = train_entity_tagger(tokenize(docs), spark.createDataFrame(phrases, "phrase string, entity_type string"))
    df = ner_tag(tokenize(texts("saw Dora Lehner there")), None, names=False)
    assert typed_names(df, tagger).first().ner == ["O", "B-PER", "I-PER", "O"]


def test_jobs_and_stage_take_a_tagger(spark, texts):
    from newsloom.annotators import build_pipeline, news_stages
    from newsloom.operators import pos_words
    from newsloom.plans.batch_trends import batch_results

    docs = corpus(texts)
    tagger = train_entity_tagger(tokenize(docs), gazetteer(spark))
    found = batch_results(docs, pos_words(spark), gazetteer=gazetteer(spark), tagger=tagger)["entity_counts"]
    assert {r.entity_type for r in found.collect()} == {"PER", "LOC"}
    lemmas = spark.createDataFrame([], "token string, lemma string")
    model = build_pipeline(news_stages(pos_words(spark), lemmas, gazetteer=gazetteer(spark), tagger=tagger)).fit(docs)
    kinds = model.transform(texts("then Zita went to Hochstadt again")).selectExpr("explode(entities.metadata) as m").selectExpr("m.entity").collect()
    assert [r.entity for r in kinds] == ["PER", "LOC"]


def test_all_words_in_phrases_are_learned_from(spark):
    """More words than any bound of earlier rounds; each rare type has one word."""
    from pyspark.sql import functions as F

    name = lambda start, i: F.concat(F.lit(start), i.cast("string"))
    id = F.col("id")
    many = spark.range(4000).select(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: name("Na", (id * 7 + i * id * 13) % 500)).alias("token"))
    rare = spark.range(8).select(F.array(name("Rare", id)).alias("token"))
    phrases = spark.range(500).select(name("Na", id).alias("phrase"), F.lit("PER").alias("entity_type"))
    phrases = phrases.unionByName(spark.range(8).select(name("Rare", id).alias("phrase"), name("T", id).alias("entity_type")))
    tagger = train_entity_tagger(many.unionByName(rare), phrases, iterations=3)
    assert tagger.types == ["PER", *[f"T{i}" for i in range(8)]]


def test_counted_rows_give_the_model_of_single_words(spark, texts):
    """The loss of words counted together is that of the words one by one."""
    tokens = tokenize(corpus(texts))
    counted, single = (train_entity_tagger(tokens, gazetteer(spark), max_rows=n) for n in (None, 1_000_000))
    assert counted.types == single.types and abs(counted.weights - single.weights).max() < 1e-3
    assert abs(counted.moves - single.moves).max() == 0
