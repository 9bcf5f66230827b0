"""Features by hand, learning on planted words, and held-out accuracy on the given labels."""

import zlib

import pytest
from pyspark.sql import functions as F

from newsloom.llm import queries as llm
from newsloom.llm.toxicity import FEATURES, Disguises, Lexicon, Words, features_of, score_toxicity, toxicity, train_toxicity

FEW = {"trees": 2, "depth": 2}  # each tree is a dozen Spark jobs
LEXICON = Lexicon(frozenset({"idiot", "scum"}), {"grol": 2.0, "grolly ": 3.0})


def features(text):
    found = features_of(text, Words(LEXICON), Disguises(LEXICON.insults))
    return dict(zip(FEATURES, found))


def test_features():
    assert set(features("").values()) == {0.0}
    told = features("You IDIOT, scum!! a b c d e f g Grolly groller x")
    assert told["insult_share"] == pytest.approx(2 / 13)
    assert told["near_second_person"] == pytest.approx(2 / 13)
    assert told["stem_weight"] == pytest.approx(5 / 13) and told["strongest"] == 3.0
    assert told["shouted"] == pytest.approx(1 / 13) and told["runs_of_marks"] == pytest.approx(1 / 13)
    assert told["capitals"] == pytest.approx(7 / 48)


@pytest.mark.parametrize("text", ["1d10t", "an i.d.i.o.t here", "i d i o t", "(id*iot)!", "$cum", "idiooooot!1 s-c-u-m"])
def test_disguises(text):
    assert features(text)["disguised"] > 0


@pytest.mark.parametrize("text", ["idiot", "scum,", "a 12 b", "e.g. x", "i d i"])
def test_no_disguise(text):
    assert features(text)["disguised"] == 0


def _corpus(spark, n=400):
    """Toxic texts have words of a stem that no list knows."""
    rows = []
    for i in range(n):
        toxic = zlib.crc32(f"{i}label".encode()) % 5 == 0
        words = [f"w{zlib.crc32(f'{i} {j}'.encode()) % 300}x".replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) for j in range(60)]
        if toxic:
            words[5:10] = ["vexorane", "vexorish", "vexorum", "vexora", "vexoring"]
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_unknown_words_are_learned(spark):
    table = _corpus(spark)
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    found = toxicity(docs, labels, **FEW).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and all(r.predicted == r.toxic for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_do_not_count(spark):
    table = _corpus(spark, 200)
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity(docs, labels, **FEW).collect()) == sorted(toxicity(docs, other, **FEW).collect())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (None, 1), (7, None), (10, 0), (11, 1)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0)):
        found = toxicity(odd, marks, **FEW).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in odd.collect())
        assert all(r.score is not None and 0 <= r.score <= 1 for r in found)
    assert toxicity(empty, labels, **FEW).collect() == []
    model = train_toxicity(odd, labels.limit(0))
    assert {r.score for r in score_toxicity(odd, model).collect()} == {0.0}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = llm.queries()["op13_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in found) >= 0.93 * len(found)
    clean = [r for r in found if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
