"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

The features are rates over a whole text: words of a lexicon, the same near a second person, in
disguise (signs for letters, letters spaced out or drawn out), capitals and punctuation. The lexicon
is a list of insults and the word stems that the labelled rows show to be used in toxic texts; these
are found by grouped aggregation over the rows the model is fitted on. Each half of those rows gets the
stems of the other half, so that trees and calibration see features as honest as those of new texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import saved, ship, text_or_empty

#: Insults and words of contempt in the languages of the corpus; an argument may replace them.
INSULTS = frozenset(
    """idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile cretin fool foolish scum scumbag
    trash garbage loser losers pathetic worthless disgusting clown clowns filth filthy vermin parasite pig swine
    ugly disgrace creep freak psycho liar coward bastard bitch asshole shit shitty fuck fucking damn crap
    jerk retard hate hateful despicable vile repulsive
    idiota idiotas imbécil estúpido estúpida basura asqueroso asquerosa payaso perdedor inútil tonto maldito mierda
    idiote imbécile stupide ordure déchet dégoûtant pathétique connard salaud minable débile merde abruti
    dumm dummkopf trottel abschaum versager arschloch scheiße widerlich erbärmlich wertlos blöd schwachkopf""".split()
)
SECOND_PERSON = frozenset(
    """you your yours yourself yourselves ur u youre tú ti tu tus usted ustedes vosotros te toi ton ta tes vous
    votre vos du dich dir dein deine deiner ihr euch euer""".split()
)
STEM_SIZES = (3, 4, 5, 6, 7, 8)
STEMS = 2_000  # of highest evidence
NEAR = 4  # words on either side
MEMO = 300_000  # words remembered by a task

_WORD = re.compile(r"[^\W\d_]+")
_MARKS = re.compile(r"[!?]{2,}")
_AROUND = ".,;:!?\"'()"
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_SIGNS = str.maketrans("013457@$!", "oieastasi")
_INSIDE = re.compile(r"(?<=[^\W_])[*.\-_~#+]+(?=[^\W_])")

FEATURES = (
    "insults", "insult_share", "stems", "stem_weight", "strongest", "near_second_person", "second_person",
    "capitals", "shouted", "exclaims", "questions", "runs_of_marks", "disguised", "drawn_out", "words",
)


@dataclass
class Lexicon:
    insults: frozenset[str]
    stems: dict[str, float]  # stem (a whole word ends in a blank) to its weight


def stems_of(word: str) -> list[str]:
    """The beginnings of a word and the word itself, marked by a blank."""
    return [word[:n] for n in STEM_SIZES if n <= len(word)] + [f"{word} "]


def undisguised(token: str) -> str:
    """A token with signs read as the letters they stand for, and marks inside it left out."""
    return _DRAWN.sub(r"\1", _INSIDE.sub("", token.lower()).translate(_SIGNS))


class Words(dict):
    """Word to what the features need of it, or None for most words: (insult, weight of its strongest
    stem, second person, capitals, shouted, drawn out, a single letter)."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) >= MEMO:
            self.clear()
        lowered, stems = word.lower(), self.lexicon.stems
        told = (
            lowered in self.lexicon.insults, max(stems.get(stem, 0.0) for stem in stems_of(lowered)), lowered in SECOND_PERSON,
            sum(map(str.isupper, word)), len(word) > 2 and word.isupper(), bool(_DRAWN.search(word)), len(word) == 1,
        )
        self[word] = found = told if any(told) else None
        return found


class Disguises(dict):
    """Token to whether it hides an insult: letters mixed with signs that spell one."""

    def __init__(self, insults: frozenset[str]):
        super().__init__()
        self.insults = insults

    def __missing__(self, token: str) -> bool:
        if len(self) >= MEMO:
            self.clear()
        inner = token.strip(_AROUND)
        mixed = not inner.isalpha() and any(map(str.isalpha, inner))
        self[token] = found = mixed and undisguised(inner) in self.insults
        return found


def features_of(text: str, words_of: Words, hidden_in: Disguises) -> tuple[float, ...]:
    """The features of a whole text, in the order of FEATURES; all 0 for an empty one."""
    words = _WORD.findall(text)
    n = len(words) or 1
    hits, second, letters = [], [], []
    weight = strongest = 0.0
    listed = learned = capitals = shouted = drawn = 0
    for place, told in enumerate(map(words_of.__getitem__, words)):
        if told is None:
            continue
        insult, known, person, upper, loud, long, single = told
        if insult or known:
            hits.append(place)
            listed += insult
            learned += known > 0
            weight += known
            strongest = max(strongest, known)
        if person:
            second.append(place)
        if single:
            letters.append(place)
        capitals += upper
        shouted += loud
        drawn += long
    near = i = 0
    for place in hits:  # both lists ascend
        while i < len(second) and second[i] < place - NEAR:
            i += 1
        near += i < len(second) and second[i] <= place + NEAR
    hidden = sum(map(hidden_in.__getitem__, text.split())) + _spaced(words, letters, hidden_in.insults)
    exclaims, questions, size = text.count("!"), text.count("?"), len(text) or 1
    marks = len(_MARKS.findall(text)) if exclaims + questions > 1 else 0
    return (
        math.log1p(listed), listed / n, math.log1p(learned), weight / n, strongest, near / n, len(second) / n,
        capitals / size, shouted / n, exclaims / size, questions / size, marks / n, hidden / n, drawn / n,
        math.log1p(len(words)),
    )


def _spaced(words: list[str], letters: list[int], insults: frozenset[str]) -> int:
    """How many insults are spelled out in four or more single letters side by side."""
    found, run = 0, []
    for place in [*letters, -1]:
        if run and place != run[-1] + 1:
            found += len(run) > 3 and "".join(words[p] for p in run).lower() in insults
            run = []
        run.append(place)
    return found


def features(docs: DataFrame, lexicons: list[Lexicon], text_col: str = "text", half_col: str | None = None) -> DataFrame:
    """The columns of `docs` but the text, and `features`, an array. With `half_col` the lexicon of that number is used
    for a row, else the first."""
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*kept, text_or_empty(text_col).alias("_text"))
    half = kept.index(half_col) if half_col else None
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("features", T.ArrayType(T.DoubleType()))])
    types = [to_arrow_type(field.dataType) for field in schema]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = [(Words(lexicon), Disguises(lexicon.insults)) for lexicon in lexicons]
        for batch in batches:
            halves = batch.column(half).to_pylist() if half is not None else [0] * batch.num_rows
            found = [features_of(text.as_py(), *tools[h]) for text, h in zip(batch.column(len(kept)), halves)]
            columns = [batch.column(i).cast(types[i]) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, types[-1])], schema.names)

    return rows.mapInArrow(measured, schema)


def stem_shares(sample: DataFrame) -> DataFrame:
    """One row per stem of at least two toxic texts, with columns for each half: `toxic0` and `clean0` are
    the shares of its words that the stem has in each text, added up by label, `texts0` the number of
    toxic texts that have it. `sample` is (text, label, half) rows."""
    rows = sample.select(text_or_empty("text").alias("text"), F.col("label").cast("int").alias("label"), "half")

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = {}
            for text, label, half in zip(*(column.to_pylist() for column in batch.columns)):
                words = _WORD.findall(text.lower())
                counts = Counter()
                for word, times in Counter(words).items():
                    for stem in stems_of(word):
                        counts[stem] += times
                for stem, times in counts.items():
                    one = sums.setdefault((half, stem), [0.0, 0.0, 0])
                    one[1 - label] += times / len(words)
                    one[2] += label
            if sums:
                halves, stems = zip(*sums)
                toxic, clean, texts = zip(*sums.values())
                columns = [pa.array(halves, pa.int32()), pa.array(stems), pa.array(toxic), pa.array(clean), pa.array(texts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["half", "stem", "toxic", "clean", "texts"])

    each = rows.mapInArrow(shares, "half int, stem string, toxic double, clean double, texts long")
    sums = [
        F.sum(F.when(F.col("half") == half, F.col(name)).otherwise(0)).alias(f"{name}{half}")
        for half in (0, 1) for name in ("toxic", "clean", "texts")
    ]
    return each.groupBy("stem").agg(*sums).where("texts0 + texts1 >= 2")


def learned_stems(
    shares: DataFrame, halves: tuple[int, ...], toxic: int, clean: int, most: int = STEMS, least_weight: float = 1.5,
    smooth: float = 1e-4,
) -> dict[str, float]:
    """Stems of words that toxic texts use more: the logarithm of the ratio of their mean shares of
    a text's words, where at least two toxic texts have the stem. Every text is one vote, however long.
    At most `most` stems come back, the rest stays on the cluster."""
    if not toxic or not clean:
        return {}
    total = lambda name: sum(F.col(f"{name}{half}") for half in halves)
    summed = shares.select("stem", *(total(name).alias(name) for name in ("toxic", "clean", "texts")))
    ratio = F.log((F.col("toxic") / toxic + smooth) / (F.col("clean") / clean + smooth))
    told = summed.where("texts >= 2").withColumn("weight", F.round(ratio, 4)).where(F.col("weight") >= least_weight)
    best = told.orderBy(F.desc("weight"), "stem").limit(most).select("stem", "weight").collect()
    return {r["stem"]: r["weight"] for r in best}


@dataclass
class ToxicityModel:
    """A lexicon, trees and a calibration; without rows of both labels a constant."""

    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    constant: float = 0.0


def train_toxicity(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, insults=INSULTS, trees: int = 12, depth: int = 3,
    id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
) -> ToxicityModel:
    """Learn from the labelled documents, or from the `fit_rows` whose ids hash lowest, the one bounded
    sample. Null ids and labels are left out; of repeated labels of an id the highest counts; of rows that
    repeat an id, the one whose text hashes lowest. The same tables give the same model."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    ship(docs.sparkSession)
    marked = (
        labels.where(F.col(label_id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(label_id_col).alias("_id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
    )
    chosen = saved(marked.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows), "toxic-labels")
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    known = rows.join(F.broadcast(chosen), "_id")  # at most fit_rows ids
    one = F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text"))
    known = known.groupBy("_id").agg(one.alias("one")).select("_id", "one.*")
    sample = saved(known.withColumn("half", F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)).cast("int")), "toxic-sample")

    counts = {(r["half"], r["label"]): r["n"] for r in sample.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    of = lambda label, *halves: sum(counts.get((half, label), 0) for half in halves)
    if not of(0, 0, 1) or not of(1, 0, 1):
        return ToxicityModel(Lexicon(frozenset(insults), {}), None, None, float(bool(of(1, 0, 1))))
    shares = saved(stem_shares(sample), "toxic-stems")

    def learned(*halves):
        return Lexicon(frozenset(insults), learned_stems(shares, halves, of(1, *halves), of(0, *halves)))

    others, lexicon = [learned(1), learned(0)], learned(0, 1)
    made = features(sample, others, "text", "half")
    table = saved(made.withColumn("features", array_to_vector("features")).withColumn("label", F.col("label").cast("double")), "toxic-features")
    table = table.orderBy("_id").coalesce(1)  # at most fit_rows short rows: the order fixes the model

    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=3, seed=7)
    parts = []
    for half in (0, 1):
        mine = table.where(F.col("half") != half)
        if of(0, 1 - half) and of(1, 1 - half):
            parts.append(boosted.fit(mine).transform(table.where(F.col("half") == half)).select("probability", "label"))
    model = boosted.fit(table)
    held = parts[0].unionByName(parts[1]) if len(parts) == 2 else model.transform(table).select("probability", "label")
    calibration = IsotonicRegression(featuresCol="probability", featureIndex=1).fit(held)
    return ToxicityModel(lexicon, model, calibration)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of `docs`: doc_id, score (0 to 1) and predicted (1 from `threshold` on). Whole
    texts are scored, a null one as empty; nothing but the text is read; no row moves."""
    from pyspark.ml.functions import array_to_vector

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model.trees is None:
        scored = rows.select("doc_id", F.lit(model.constant).alias("score"))
    else:
        made = features(rows, [model.lexicon], "text")
        guessed = model.trees.transform(made.withColumn("features", array_to_vector("features"))).select("doc_id", "probability")
        scored = model.calibration.transform(guessed).select("doc_id", _within(F.col("prediction")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _within(score: Column) -> Column:
    return F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether an id is kept from learning: crc32 of its text leaves 2 modulo 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_id_col: str = "doc_id", **how) -> DataFrame:
    """`train_toxicity` on the labels of ids that are not held out, then `score_toxicity` on all rows of
    `docs`, with a column held_out. An empty table gives no rows; without labels all scores are 0."""
    scoring = {name: how.pop(name) for name in ("threshold",) if name in how}
    model = train_toxicity(docs, labels.where(~held_out(label_id_col)), id_col=id_col, label_id_col=label_id_col, **how)
    scored = score_toxicity(docs, model, id_col, how.get("text_col", "text"), **scoring)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
