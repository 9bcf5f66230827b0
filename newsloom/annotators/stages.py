"""The annotation operators as `pyspark.ml` stages.

Every stage adds a column of annotations, `array<struct<result, metadata>>`, so that
`col.result` is an array of texts, and composes with the feature stages of `pyspark.ml`. Stages, and
pipelines of them, fitted or not, are saved with their tables and learned taggers.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import EN_STOP
from ..functions import settle
from ..operators.chunks import CHUNKS, iob_to_chunks
from ..operators.lexicon import lemma_arrays, tag_arrays, vector_arrays
from ..operators.perceptron import ContextTagger, tag_in_context
from ..operators.tagger import tag_entities
from ..operators.tfidf import NUM_FEATURES
from ..operators.tokens import finish, remove_stopwords, tokens_of
from .storage import StageReader, StageWriter

_TOKENS, _VALUES = "_tokens", "_values_out"


def annotations(values) -> Column:
    """Texts as annotations without metadata."""
    return F.transform(
        values,
        lambda value: F.struct(value.alias("result"), F.lit(None).cast("map<string,string>").alias("metadata")),
    ).cast(CHUNKS)


class _Stage(Transformer, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    reads, adds = "token", ""
    holds: tuple[str, ...] = ()  # what a stage has beside its parameters

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(inputCol=inputCol or self.reads, outputCol=outputCol or self.adds)

    @classmethod
    def blank(cls):
        """A stage with default columns that holds nothing yet."""
        stage = cls.__new__(cls)
        _Stage.__init__(stage)
        return stage

    def write(self) -> StageWriter:
        return StageWriter(self)

    @classmethod
    def read(cls) -> StageReader:
        return StageReader(cls)

    def _tokens(self, df: DataFrame) -> DataFrame:
        return settle(df, _TOKENS, F.col(f"{self.getInputCol()}.result"))

    def _annotated(self, df: DataFrame) -> DataFrame:
        return settle(df, self.getOutputCol(), annotations(_VALUES)).drop(_TOKENS, _VALUES)


class TextAssembler(_Stage):
    """A text column to one document annotation."""

    reads, adds = "text", "document"

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(), annotations(F.array(F.col(self.getInputCol()))))


class Tokenizer(_Stage):
    reads, adds = "document", "token"

    def _transform(self, df):
        words = F.flatten(F.transform(f"{self.getInputCol()}.result", tokens_of))
        return self._annotated(settle(df, _VALUES, words))


class StopWords(_Stage):
    """Drop the words of a list or a table, whatever their case."""

    adds, holds = "cleanTokens", ("words",)

    def __init__(self, inputCol=None, outputCol=None, words=EN_STOP):
        super().__init__(inputCol, outputCol)
        self.words = words if isinstance(words, DataFrame) else list(words)

    def _transform(self, df):
        return self._annotated(remove_stopwords(self._tokens(df), self.words, _TOKENS, _VALUES))


class _LexiconStage(_Stage):
    holds = ("lexicon",)

    def __init__(self, lexicon: DataFrame | ContextTagger, inputCol=None, outputCol=None):
        super().__init__(inputCol, outputCol)
        self.lexicon = lexicon


class PosTagger(_LexiconStage):
    """Tags by a lexicon and word shapes, or in context by a learned tagger in the lexicon's place."""

    adds = "pos"

    def _transform(self, df):
        if isinstance(self.lexicon, ContextTagger):
            return self._annotated(tag_in_context(self._tokens(df), self.lexicon, _TOKENS, _VALUES))
        return self._annotated(tag_arrays(self._tokens(df), self.lexicon, _TOKENS, _VALUES))


class Lemmatizer(_LexiconStage):
    reads, adds = "cleanTokens", "lemma"

    def _transform(self, df):
        return self._annotated(lemma_arrays(self._tokens(df), self.lexicon, _TOKENS, _VALUES))


class Embedder(_LexiconStage):
    """One vector per token, null where unknown; plain arrays instead of annotations."""

    adds = "word_embeddings"

    def _transform(self, df):
        return vector_arrays(self._tokens(df), self.lexicon, _TOKENS, self.getOutputCol()).drop(_TOKENS)


class EntityTagger(_Stage):
    """One IOB tag per token: the gazetteer's, then for other capitalised words the type a learned
    `tagger` finds, or one type for all without it."""

    adds, holds = "ner", ("gazetteer", "tagger", "ner_args")

    def __init__(self, gazetteer: DataFrame | None = None, inputCol=None, outputCol=None, tagger=None, **ner_args):
        super().__init__(inputCol, outputCol)
        self.gazetteer, self.tagger, self.ner_args = gazetteer, tagger, ner_args

    def _transform(self, df):
        tagged = tag_entities(self._tokens(df), self.gazetteer, self.tagger, _TOKENS, _VALUES, **self.ner_args)
        return self._annotated(tagged)


class Chunker(_Stage):
    """Tags and their tokens to entity chunks with `metadata.entity`."""

    reads, adds, holds = "ner", "entities", ("tokens_col",)

    def __init__(self, inputCol=None, outputCol=None, tokensCol: str = "token"):
        super().__init__(inputCol, outputCol)
        self.tokens_col = tokensCol

    def _transform(self, df):
        both = settle(df, _TOKENS, F.col(f"{self.tokens_col}.result"))
        both = settle(both, _VALUES, F.col(f"{self.getInputCol()}.result"))
        return iob_to_chunks(both, _TOKENS, _VALUES, self.getOutputCol()).drop(_TOKENS, _VALUES)


class Finisher(_Stage):
    """Annotations to plain texts; the annotations stay."""

    reads, adds = "lemma", "finished_lemma"

    def _transform(self, df):
        return finish(df, self.getInputCol(), self.getOutputCol())


def build_pipeline(stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def news_stages(
    pos_lexicon: DataFrame | ContextTagger,
    lemma_lexicon: DataFrame,
    vectors: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    stopwords=EN_STOP,
    num_features: int = NUM_FEATURES,
    tagger=None,
) -> list:
    """The stages of the batch analysis. Tags and entities read all tokens, lemmas and features the
    tokens that are no stop words.

    Fitting only runs the stages up to the last one that learns from the corpus, so those that
    the features do not need come after it.
    """
    embedder = [] if vectors is None else [Embedder(vectors)]
    return [
        TextAssembler(),
        Tokenizer(),
        StopWords(words=stopwords),
        Lemmatizer(lemma_lexicon),
        Finisher(),
        HashingTF(inputCol="finished_lemma", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
        PosTagger(pos_lexicon),
        *embedder,
        EntityTagger(gazetteer, tagger=tagger),
        Chunker(),
    ]
