
from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom import fixed_values as fixed, word_shapes as shapes
from newsloom.annotators import build_pipeline, news_stages
from newsloom.functions import settle
from newsloom.operators import (
    annotate_entities, article_lines, assemble, chunk_spans, classify_topic, embed, enrich_articles, entity_counts,
    entity_type_counts, extract_entities, flatten_articles, frequency_changes, guess_lemmas, iob_to_chunks, keyword_counts, lemmatize, merge_frequencies,
    ner_tag, pos_frequencies, pos_tag, pos_words, prepare_gazetteer, remove_stopwords, tag_arrays, tag_in_context, term_frequencies,
    term_tfidf, texts_at, tfidf, to_messages, token_counts, token_rows, token_spans, tokenize, topic_counts, topic_trends,
    train_context_tagger, train_entity_tagger, train_lemma_rules, train_pos_lexicon, trending_entities, typed_names, weigh_terms, word_cloud, word_frequencies,
)
from newsloom.session import scratch_dir, spread, state_session
from newsloom.sinks import (
    HourlyTable, WindowTable, batch_table, read_batches, read_replaced, replaced_table, start,
)
from newsloom.sources import line_stream, load_lexicon, message_stream, read_wordlist
from newsloom.streaming import (
    CLOUD_KEYS, TREND_KEYS, article_query, entity_query, frequency_query, live_trending_query, message_query, topic_query, trending_query,
    word_cloud_query,
)

try:  # the operators for training data are a part that can be left out
    import corpus_pipeline
    from newsloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "newsloom.llm"):
        raise
    llm_queries = None

AS_OF = "2024-01-31 12:00:00"
GAZETTEER_LEAST = 3  # names found at least so often


# ---------------------------------------------------------------- inputs


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


def _documents(spark, sf_dir, *columns):
    return _table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def _tokens(spark, sf_dir):
    return tokenize(assemble(_documents(spark, sf_dir)))


def _classified(spark, sf_dir, **args):
    return classify_topic(_documents(spark, sf_dir), "text", **args)


def _written(df: DataFrame, name: str) -> str:
    """A table of the corpus in the shared folder, as lexicons come."""
    path = f"{scratch_dir(df.sparkSession, name)}.parquet"
    df.write.parquet(path)
    return path


def _saved(df: DataFrame, name: str) -> DataFrame:
    return load_lexicon(df.sparkSession, _written(df, name))


def _names(spark, sf_dir):
    """Documents with their runs of capitalised words."""
    return annotate_entities(_documents(spark, sf_dir), "text")


def _gazetteer(spark, sf_dir):
    """All names that come often in the corpus as phrases, with a type by their length; written once."""
    kind = F.col("n") % 3
    names = (
        entity_counts(_names(spark, sf_dir), None)
        .where(F.col("count") >= GAZETTEER_LEAST)
        .withColumn("n", F.length("entity"))
        .select(
            F.col("entity").alias("phrase"),
            F.when(kind == 0, "PER").when(kind == 1, "LOC").otherwise("ORG").alias("entity_type"),
        )
    )
    return load_lexicon(spark, _written(names, "names"), "phrase", "entity_type")


def _large_gazetteer(spark, sf_dir):
    """The gazetteer among all n-grams of one to three words that no text has: each ends in a mark that
    tokens never hold. As many phrases as the corpus has tokens, for the ways of large gazetteers."""
    tokens = _tokens(spark, sf_dir)
    grams = F.transform(
        F.sequence(F.lit(0), F.size("token") - 1),
        lambda i: F.concat(F.array_join(F.slice("token", i + 1, i % 3 + 1), " "), F.lit(",")),
    )
    others = tokens.where(F.size("token") > 0).select(F.explode(grams).alias("phrase")).distinct()
    return _gazetteer(spark, sf_dir).unionByName(others.withColumn("entity_type", F.lit("NONE")))


def _plurals(spark, sf_dir):
    """A (token, lemma) lexicon of the corpus: a word and the same word with an s."""
    words = token_counts(_tokens(spark, sf_dir)).select("token")
    singular = words.select(F.col("token").alias("lemma"), F.concat("token", F.lit("s")).alias("token"))
    return _saved(words.join(singular, "token").select("token", "lemma"), "plurals")


def _vectors(spark, sf_dir):
    """A (token, vector) table: words without a capital get one of the given embeddings."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    number = F.conv(F.substring(F.md5("token"), 1, 6), 16, 10).cast("long")
    count = table.agg(F.count("*")).scalar()
    words = (
        token_counts(_tokens(spark, sf_dir))
        .where(F.col("token").rlike(r"^\p{L}"))
        .select("token", F.pmod(number, count).alias("vec_id"))
    )
    return _saved(words.join(table, "vec_id").select("token", F.col("embedding").alias("vector")), "vectors")


def _articles(spark, sf_dir):
    """Documents as articles in which some fields are missing."""
    return _documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars").select(
        "source",
        F.col("text").alias("title"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("author"),
        F.when(F.col("n_chars") > 400, F.col("source")).alias("description"),
        F.when(F.col("lang") != "es", F.concat(F.lit("news/"), "doc_id")).alias("url"),
        F.when(F.col("n_chars") % 2 == 0, F.col("n_chars").cast("string")).alias("publishedAt"),
    )


def _entity_events(spark, sf_dir):
    return _table(spark, sf_dir, "events", "ts", "user_id", "event_type").select(
        F.concat(F.lit("user"), "user_id").alias("entity_name"),
        F.col("event_type").alias("entity_type"),
        F.col("ts").alias("detected_at"),
    )


def _stream(spark, sf_dir, name):
    """A table, one file or a folder of them, as a file stream."""
    path = f"{sf_dir}/{name}.parquet"
    table = spark.read.parquet(path)
    files = table.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}.parquet"):  # a stream reads folders only
        return line_stream(spark, "parquet", table.schema, sf_dir, pathGlobFilter=f"{name}.parquet")
    return line_stream(spark, "parquet", table.schema, path)


# ---------------------------------------------------------------- queries


def _plain_article(df):
    """The empty score as text, so that both engines show it alike."""
    return df.withColumn("sentiment_score", F.coalesce(F.col("sentiment_score").cast("string"), F.lit("none")))


def q_article_enrich(spark, sf_dir):
    articles = enrich_articles(_documents(spark, sf_dir), "text", ts=_as_of(), keep=("doc_id",))
    return _plain_article(articles)


def q_topic_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "detected_topic")


def q_topic_whole_word(spark, sf_dir):
    return _classified(spark, sf_dir, whole_word=True).select("doc_id", "detected_topic")


def q_topic_counts(spark, sf_dir):
    return topic_counts(_classified(spark, sf_dir))


def _plain_trends(df):
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("time_window", "first_seen", "last_seen")}
    return df.withColumns({"sources": F.concat_ws(",", "sources"), **times})


def q_topic_trend_1min(spark, sf_dir):
    return _plain_trends(topic_trends(_table(spark, sf_dir, "events", "ts", "event_type"), "event_type", "ts"))


def q_wordcloud(spark, sf_dir):
    return word_frequencies(_classified(spark, sf_dir), "text", "detected_topic")


def q_wordcloud_style(spark, sf_dir):
    return word_cloud(_classified(spark, sf_dir), "text", "detected_topic", as_of=_as_of())


def q_punct_clean(spark, sf_dir):
    return assemble(_documents(spark, sf_dir))


def _joined(df, column):
    return df.select("doc_id", F.size(column).alias("n"), F.array_join(column, " ").alias("words"))


def q_tokens(spark, sf_dir):
    return _joined(_tokens(spark, sf_dir), "token")


def q_token_spans(spark, sf_dir):
    """Tokens with their places: how many characters they hold, those that the text does not have there,
    and the same of the names among them."""
    spans = settle(token_spans(_documents(spark, sf_dir)), "token", F.col("spans.token"))
    found = chunk_spans(ner_tag(spans, None))
    for name in ("spans", "chunks"):
        places = settle(settle(found, "_begins", F.col(f"{name}.begin")), "_ends", F.col(f"{name}.end"))
        found = texts_at(places, "text", "_begins", "_ends", f"{name}_there").drop("_begins", "_ends")
    every = lambda c, value: F.aggregate(c, F.lit(0).cast("long"), lambda n, s: n + value(s))
    alike = lambda c, name: F.zip_with(c, f"{c}_there", lambda s, there: there == s[name])
    wrong = lambda c, name: every(alike(c, name), lambda same: F.when(same, 0).otherwise(1))
    return found.select(
        "doc_id", every("spans", lambda s: s["end"] - s["begin"]).alias("characters"),
        wrong("spans", "token").alias("misplaced"), wrong("chunks", "result").alias("misplaced_names"),
    )


def q_stopword_removed(spark, sf_dir):
    return _joined(remove_stopwords(_tokens(spark, sf_dir)), "cleanTokens")


def q_stopword_table(spark, sf_dir):
    """Stop words from a word list file: the short words of the corpus."""
    path = scratch_dir(spark, "words")
    counted = token_counts(_tokens(spark, sf_dir))
    counted.where(F.length("token") <= 3).select("token").write.text(path)
    return _joined(remove_stopwords(_tokens(spark, sf_dir), read_wordlist(spark, path)), "cleanTokens")


def q_keyword_counts(spark, sf_dir):
    return keyword_counts(_tokens(spark, sf_dir))


def q_keyword_top10(spark, sf_dir):
    return keyword_counts(_tokens(spark, sf_dir), k=10)


def q_lemma_counts(spark, sf_dir):
    return keyword_counts(_tokens(spark, sf_dir), _plurals(spark, sf_dir))


def q_lemma_counts_dup(spark, sf_dir):
    """A lexicon with two lemmas for each plural: the first in the alphabet counts."""
    plurals = _plurals(spark, sf_dir)
    twice = plurals.unionByName(plurals.withColumn("lemma", F.concat(F.lit("!"), "token")))
    return keyword_counts(_tokens(spark, sf_dir), twice)


def q_lemmas_per_document(spark, sf_dir):
    rows = term_frequencies(_tokens(spark, sf_dir)).withColumnRenamed("term", "token")
    lemmas = lemmatize(rows, _plurals(spark, sf_dir))
    return lemmas.groupBy("doc_id").agg(
        F.count_distinct("lemma").alias("lemmas"),
        F.sum(F.when(F.col("lemma") != F.col("token"), F.col("tf")).otherwise(0)).alias("changed"),
    )


def q_lemma_rules(spark, sf_dir):
    """Lemmas of all words but half of the plurals and their singulars, which the rules are learned from."""
    words = token_counts(_tokens(spark, sf_dir)).select("token")
    pairs = _plurals(spark, sf_dir).where("conv(substring(md5(lemma), 1, 1), 16, 10) < 8")
    lexicon = pairs.unionByName(pairs.select(F.col("lemma").alias("token"), "lemma"))
    return guess_lemmas(words, train_lemma_rules(lexicon), lexicon)


def q_pos_counts_top20(spark, sf_dir):
    return pos_frequencies(_tokens(spark, sf_dir), pos_words(spark))


def q_pos_counts_dup(spark, sf_dir):
    """A lexicon in mixed case with two tags for each word: the first in the alphabet counts."""
    words = pos_words(spark)
    twice = words.unionByName(words.select(F.initcap("token").alias("token"), F.lit("ZZ").alias("tag")))
    return pos_frequencies(_tokens(spark, sf_dir), twice)


def q_pos_tagged(spark, sf_dir):
    tagged = pos_tag(token_rows(_tokens(spark, sf_dir)), pos_words(spark))
    return tagged.groupBy("doc_id", "pos_tag").agg(F.count("*").alias("count"))


def q_pos_lexicon(spark, sf_dir):
    tagged = pos_tag(token_rows(_tokens(spark, sf_dir)), pos_words(spark))
    return train_pos_lexicon(tagged.select(F.lower("token").alias("token"), F.col("pos_tag").alias("tag")))


def _by_neighbour(tokens):
    """Tags that the word alone does not tell: a word is a verb after one that ends in a vowel."""
    def tag(token, i):
        before = F.lower(F.coalesce(F.get("token", i - 1), F.lit("")))
        return F.when(token.rlike("^[0-9]"), "CD").when(before.rlike("[aeiou]$"), "VB").otherwise("NN")

    return tokens.withColumn("tag", F.transform("token", tag))


def q_pos_context(spark, sf_dir):
    """A tagger of context learned from three quarters of the documents; on the others, whether it
    is better than the lexicon learned from the same, and finds nearly all tags."""
    tagged = _by_neighbour(_tokens(spark, sf_dir).where(F.size("token") > 0))
    seen, new = tagged.where("doc_id % 4 != 0"), tagged.where("doc_id % 4 = 0")
    found = tag_in_context(new, train_context_tagger(seen, epochs=3), out="pos")
    rows = seen.select(F.inline(F.arrays_zip("token", "tag")))
    lexicon = train_pos_lexicon(rows.select(F.lower("token").alias("token"), "tag"))
    found = tag_arrays(found, lexicon, "token", "listed")
    alike = lambda name: F.sum(F.size(F.filter(F.arrays_zip(F.col("tag"), F.col(name).alias("guess")), lambda z: z["tag"] == z["guess"])))
    return found.agg(
        F.count("*").alias("documents"), F.sum(F.size("pos")).alias("tokens"),
        (alike("pos") > alike("listed")).alias("above_lexicon"),
        (alike("pos") >= 0.95 * F.sum(F.size("token"))).alias("nearly_all"),
    )


def _chunk_list(df):
    """One row per document: its chunks in order."""
    shown = F.transform("entities", lambda c: F.concat(c["result"], F.lit("/"), c["metadata"]["entity"]))
    return df.select("doc_id", F.size("entities").alias("n"), F.array_join(shown, "|").alias("chunks"))


def q_entity_spans(spark, sf_dir):
    return _chunk_list(_names(spark, sf_dir))


def q_entity_tagger(spark, sf_dir):
    """A tagger learned from the gazetteer: words in phrases, other names, and those it left untyped."""
    tokens = _tokens(spark, sf_dir)
    gazetteer = prepare_gazetteer(_gazetteer(spark, sf_dir))
    tagger = train_entity_tagger(tokens, gazetteer)
    matched = ner_tag(tokens, gazetteer, names=False, out="matched")
    tagged = typed_names(matched.withColumn("ner", F.col("matched")), tagger)
    inside = F.filter("matched", lambda tag: tag != "O")
    new = F.filter(F.arrays_zip("matched", "ner"), lambda z: (z["matched"] == "O") & (z["ner"] != "O"))
    known = F.filter("ner", lambda tag: (tag == "O") | F.substr(tag, F.lit(3)).isin(*tagger.types))
    return tagged.select(
        "doc_id", F.size("token").alias("tokens"), F.size(inside).alias("in_phrases"), F.size(new).alias("typed"),
        (F.size("ner") - F.size(known)).alias("of_no_type"),
    )


def q_entity_sequences(spark, sf_dir):
    """Types by a name's ending, learned from a part of the names and decoded for the others: their words, illegal
    sequences, and whether more chunks have the right type than if all had the most frequent one."""
    ending = lambda c: F.when(F.col(c).rlike("[aeiounrs]$"), "PER").otherwise("LOC")
    tokens = _tokens(spark, sf_dir)
    names = _gazetteer(spark, sf_dir).where("conv(substring(md5(phrase), 1, 1), 16, 10) >= 8")
    gazetteer = prepare_gazetteer(names.withColumn("entity_type", ending("phrase")))
    matched = ner_tag(tokens, gazetteer, names=False, out="matched")
    tagged = typed_names(matched.withColumn("ner", F.col("matched")), train_entity_tagger(tokens, gazetteer))
    new = F.transform("ner", lambda tag, i: F.when(F.get("matched", i) == "O", tag).otherwise("O"))
    tagged = tagged.select("doc_id", "token", new.alias("ner"))
    goes_on = lambda tag, i: tag.startswith("I-") & (F.substr(F.coalesce(F.get("ner", i - 1), F.lit("O")), F.lit(3)) != F.substr(tag, F.lit(3)))
    words = tagged.select(
        F.size(F.filter("ner", lambda tag: tag != "O")).alias("words"), F.size(F.filter("ner", goes_on)).alias("illegal")
    ).agg(F.sum("words").alias("words"), F.sum("illegal").alias("illegal"))
    chunks = iob_to_chunks(tagged).select(F.explode("entities").alias("c")).select(
        F.col("c.metadata")["entity"].alias("found"), ending("c.result").alias("right"))
    right = lambda kind: F.avg((F.col("right") == kind).cast("int"))
    most = F.greatest(right(F.lit("PER")), right(F.lit("LOC")))
    return words.crossJoin(chunks.agg((right(F.col("found")) > most).alias("above_majority")))  # one row each


def q_entity_counts_top10(spark, sf_dir):
    return entity_counts(_names(spark, sf_dir))


def q_gazetteer_match(spark, sf_dir):
    tagged = ner_tag(_tokens(spark, sf_dir), _gazetteer(spark, sf_dir), names=False)
    return _chunk_list(iob_to_chunks(tagged))


def q_gazetteer_match_carried(spark, sf_dir):
    """A large gazetteer that travels to the tasks."""
    tagged = ner_tag(
        _tokens(spark, sf_dir), _large_gazetteer(spark, sf_dir), names=False, carry_phrases=5_000_000
    )
    return _chunk_list(iob_to_chunks(tagged))


def q_gazetteer_match_joined(spark, sf_dir):
    """The way taken for a gazetteer too large to travel to the tasks."""
    tagged = ner_tag(_tokens(spark, sf_dir), _large_gazetteer(spark, sf_dir), names=False, carry_phrases=0)
    return _chunk_list(iob_to_chunks(tagged))


def q_entity_type_counts(spark, sf_dir):
    annotated = annotate_entities(_documents(spark, sf_dir), "text", _gazetteer(spark, sf_dir))
    return entity_type_counts(annotated, date="2024-01-31").withColumn(
        "date_recorded", F.col("date_recorded").cast("string")
    )


def q_iob_chunks(spark, sf_dir):
    def tag(token):
        n = F.length(token) % 5
        return F.when(n == 0, "B-PER").when(n == 1, "I-PER").when(n == 2, "I-LOC").otherwise("O")

    return _chunk_list(iob_to_chunks(_tokens(spark, sf_dir).withColumn("ner", F.transform("token", tag))))


def q_extracted_entities(spark, sf_dir):
    return extract_entities(_table(spark, sf_dir, "conversations", "text"), "text", as_of=_as_of())


def q_trending_entities(spark, sf_dir):
    entities = _entity_events(spark, sf_dir)
    return trending_entities(entities, entities.agg(F.max("detected_at")).scalar())


def q_trending_entities_day(spark, sf_dir):
    entities = _entity_events(spark, sf_dir)
    return trending_entities(entities, entities.agg(F.max("detected_at")).scalar(), lookback="24 hours")


def q_term_tfidf(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weighted = term_tfidf(remove_stopwords(_tokens(spark, sf_dir)), terms_col="cleanTokens", documents=documents)
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


def q_updated_tfidf(spark, sf_dir):
    """Weights after the German documents were withdrawn from frequencies of all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    german = F.col("lang").eqNullSafe("de")
    terms = lambda rows: remove_stopwords(tokenize(assemble(spread(rows))))
    every = frequency_changes(terms(documents), "cleanTokens")
    gone = frequency_changes(terms(documents.where(german)).withColumn("change", F.lit(-1)), "cleanTokens", "change")
    left = terms(documents.where(~german))
    return weigh_terms(left, merge_frequencies(every, gone), terms_col="cleanTokens").withColumn("tfidf", F.round("tfidf", 6))


def q_hashing_tfidf(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    features = tfidf(remove_stopwords(_tokens(spark, sf_dir)), "cleanTokens")
    values = vector_to_array("features")
    return features.select(
        "doc_id",
        F.size(F.filter(vector_to_array("rawFeatures"), lambda v: v > 0)).alias("buckets"),
        F.round(F.aggregate(values, F.lit(0.0), lambda total, v: total + v), 3).alias("weight"),
    )


def q_token_embeddings(spark, sf_dir):
    rows = term_frequencies(_tokens(spark, sf_dir)).withColumnRenamed("term", "token")

    @F.arrow_udf("long")
    def every(vectors: pa.Array) -> pa.Array:
        """All dimensions in whole millionths, each times its place from 1."""
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        flat = vectors.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets, none = offsets - offsets[0], flat.is_null().to_numpy(zero_copy_only=False)
        values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) * 1e6
        whole = np.trunc(values)
        whole += np.where(np.abs(values - whole) >= 0.5, np.sign(values), 0)  # halves away from zero
        place = np.arange(len(whole)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1
        within = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
        return pa.array(within(whole.astype(np.int64) * place), mask=(within(none) > 0) | (np.diff(offsets) == 0))

    return (
        embed(rows, _vectors(spark, sf_dir))
        .groupBy("doc_id")
        .agg(
            F.sum("tf").alias("tokens"),
            F.sum(F.when(F.col("vector").isNotNull(), F.col("tf")).otherwise(0)).alias("known"),
            F.coalesce(F.sum(every("vector") * F.col("tf")), F.lit(0)).alias("all_dimensions"),
        )
    )


def q_json_articles(spark, sf_dir):
    return flatten_articles(to_messages(_articles(spark, sf_dir), ("source",)))


def q_json_dirty(spark, sf_dir):
    """Messages of which many are unreadable, without articles, or without fields."""
    article = F.struct(F.col("text").alias("title"), F.when(F.col("lang") != "de", F.col("lang")).alias("author"))
    kind = F.pmod("doc_id", F.lit(6))
    value = (
        F.when(kind == 0, "{bad").when(kind == 1, '{"articles":{}}').when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, '{"articles":[null,"text",{"title":5,"title":null}]}')
        .otherwise(F.to_json(F.struct(F.array(article).alias("articles"))))
    )
    messages = _documents(spark, sf_dir, "doc_id", "text", "lang").select("doc_id", value.alias("value"))
    return flatten_articles(messages, keep=("doc_id",))


def q_article_lines(spark, sf_dir):
    return article_lines(flatten_articles(to_messages(_articles(spark, sf_dir), ("source",))))


def _plain_documents(spark, sf_dir):
    return _documents(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"[,\.!?]", ""))


def q_annotation_stages(spark, sf_dir):
    """The stages as one fitted pipeline."""
    documents = _plain_documents(spark, sf_dir)
    return _stage_counts(build_pipeline(news_stages(pos_words(spark), _plurals(spark, sf_dir))).fit(documents), documents)


def q_saved_stages(spark, sf_dir):
    """The fitted pipeline, written, read back and used."""
    documents, path = _plain_documents(spark, sf_dir), scratch_dir(spark, "stages")
    build_pipeline(news_stages(pos_words(spark), _plurals(spark, sf_dir))).fit(documents).write().save(path)
    return _stage_counts(PipelineModel.load(path), documents)


def _stage_counts(model, documents):
    nouns = F.filter("pos", lambda p: p["result"].startswith("NN"))
    return model.transform(documents).select(
        "doc_id",
        F.size("token").alias("tokens"),
        F.size(nouns).alias("nouns"),
        F.size("cleanTokens").alias("clean"),
        F.array_join("finished_lemma", " ").alias("lemmas"),
        F.size("entities").alias("entities"),
    )


def q_stream_articles(spark, sf_dir):
    path = scratch_dir(spark, "articles")
    articles = enrich_articles(_stream(spark, sf_dir, "documents"), "text", ts=_as_of(), keep=("doc_id",))
    article_query(articles, batch_table(f"{path}/out"), f"{path}/checkpoint", None).awaitTermination()
    return _plain_article(read_batches(spark, f"{path}/out"))


def q_stream_topic_trend(spark, sf_dir):
    path = scratch_dir(spark, "topics")
    table = WindowTable(f"{path}/out", TREND_KEYS)
    topic_query(_stream(spark, sf_dir, "events"), table, f"{path}/checkpoint", None, "event_type", "ts").awaitTermination()
    return _plain_trends(table.read(spark))


def q_stream_topic_complete(spark, sf_dir):
    """The complete result at each trigger."""
    path = scratch_dir(spark, "topics")
    topic_query(
        _stream(spark, sf_dir, "events"), replaced_table(f"{path}/out"), f"{path}/checkpoint", None,
        "event_type", "ts", watermark=None,
    ).awaitTermination()
    return _plain_trends(read_replaced(spark, f"{path}/out"))


def q_stream_wordcloud(spark, sf_dir):
    path = scratch_dir(spark, "wordcloud")
    articles = enrich_articles(_stream(spark, sf_dir, "documents"), "text", ts=_as_of())
    table = WindowTable(f"{path}/out", CLOUD_KEYS, keep=dt.timedelta(hours=4))
    word_cloud_query(articles, table, f"{path}/checkpoint", None, as_of=_as_of()).awaitTermination()
    return table.read(spark).drop("time_window")


def q_stream_extracted_entities(spark, sf_dir):
    path = scratch_dir(spark, "entities")
    schema = extract_entities(spark.createDataFrame([], "text string"), "text", as_of=_as_of()).schema
    entities = HourlyTable(f"{path}/entities", "detected_at", schema)
    entity_query(
        _stream(spark, sf_dir, "conversations"), batch_table(f"{path}/articles"), entities,
        f"{path}/checkpoint", text_col="text", every=None, as_of=_as_of(),
    ).awaitTermination()
    return entities.read(spark)


def q_stream_entity_articles(spark, sf_dir):
    """The articles of the entity stream, read back."""
    path = scratch_dir(spark, "entities")
    entity_query(
        _stream(spark, sf_dir, "documents"), batch_table(f"{path}/articles"), batch_table(f"{path}/entities"),
        f"{path}/checkpoint", text_col="text", every=None, as_of=_as_of(),
    ).awaitTermination()
    return _plain_article(read_batches(spark, f"{path}/articles"))


def q_stream_trending_entities(spark, sf_dir):
    path = scratch_dir(spark, "trending")
    events = _entity_events(spark, sf_dir)
    table = HourlyTable(f"{path}/entities", "detected_at", events.schema, hours=24)
    stream = _stream(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), "user_id").alias("entity_name"), F.col("event_type").alias("entity_type"),
        F.col("ts").alias("detected_at"),
    )
    start(stream, table, f"{path}/entities-checkpoint").awaitTermination()
    last = events.agg(F.max("detected_at")).first()[0]
    trending_query(
        _stream(spark, sf_dir, "events"), lambda: table.read(spark, last - dt.timedelta(minutes=10)),
        replaced_table(f"{path}/out"), f"{path}/checkpoint", None, lambda entities: F.lit(last),
    ).awaitTermination()
    return read_replaced(spark, f"{path}/out")


def q_stream_trending_live(spark, sf_dir):
    """The same from state, in several triggers whose events come in no order."""
    path = scratch_dir(spark, "trending-live")
    _entity_events(spark, sf_dir).repartition(4, "detected_at").write.parquet(f"{path}/landed")
    schema = spark.read.parquet(f"{path}/landed").schema
    events = line_stream(state_session(spark), "parquet", schema, f"{path}/landed", maxFilesPerTrigger=1)
    live_trending_query(events, f"{path}/live", replaced_table(f"{path}/out"), f"{path}/checkpoint", None).awaitTermination()
    return read_replaced(spark, f"{path}/out").withColumn("time_window", F.col("time_window").cast("timestamp_ntz"))


def q_stream_document_frequencies(spark, sf_dir):
    path = scratch_dir(spark, "frequencies")
    documents = remove_stopwords(tokenize(assemble(_stream(spark, sf_dir, "documents"))))
    frequency_query(documents, batch_table(f"{path}/out"), f"{path}/checkpoint", None, "cleanTokens").awaitTermination()
    merged = merge_frequencies(read_batches(spark, f"{path}/out"))
    return merged.withColumn("term", F.coalesce("term", F.lit("all documents")))


def q_stream_article_lines(spark, sf_dir):
    path = scratch_dir(spark, "messages")
    to_messages(_articles(spark, sf_dir), ("source",)).select("value").write.text(f"{path}/landed")
    messages = message_stream(spark, f"{path}/landed")
    message_query(messages, f"{path}/out", f"{path}/checkpoint", None).awaitTermination()
    return spark.read.text(f"{path}/out").withColumnRenamed("value", "line")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the styled word cloud of the classified documents."""
    return q_wordcloud_style(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return own if llm_queries is None else {**own, **llm_queries.queries(), "pipeline": corpus_pipeline.run}


# ---------------------------------------------------------------- the same in SQL


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _topic(text: str = "text", whole_word: bool = False) -> str:
    rules = []
    for name, words in fixed.TOPIC_RULES:
        if whole_word:
            edge = r"[^\p{L}\p{N}]"
            found = f"regexp_matches(lower({text}), '(^|{edge})({'|'.join(words)})({edge}|$)')"
        else:
            found = " OR ".join(f"contains(lower({text}), '{w}')" for w in words)
        rules.append(f"WHEN {found} THEN '{name}'")
    return f"CASE {' '.join(rules)} ELSE '{fixed.OTHER_TOPIC}' END"


def _tokens_cte(table="documents", key="doc_id") -> str:
    return rf"""tokens AS (
        SELECT {key} AS doc_id, list_filter(string_split_regex(
            regexp_replace(text, '[,.!?]', '', 'g'), '\s+'), lambda w: w <> '') AS token
        FROM {table}),
    tok AS (
        SELECT doc_id, unnest(token) AS token, generate_subscripts(token, 1) - 1 AS pos FROM tokens)"""


_NAME = r"regexp_matches(token, '^\p{Lu}[\p{L}\p{N}''’-]*$') AND lower(token) NOT IN (" + _quoted(fixed.EN_STOP) + ")"


def _spans_cte(source="tok") -> str:
    return f"""name AS (
        SELECT doc_id, pos, token, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island
        FROM {source} WHERE {_NAME}),
    span AS (
        SELECT doc_id, min(pos) AS pos, string_agg(token, ' ' ORDER BY pos) AS entity, '{shapes.NAME_TYPE}' AS entity_type
        FROM name GROUP BY doc_id, island)"""


_GAZETTEER = f"""gazetteer AS (
        SELECT entity AS phrase, len(string_split(entity, ' ')) AS n,
               CASE length(entity) % 3 WHEN 0 THEN 'PER' WHEN 1 THEN 'LOC' ELSE 'ORG' END AS entity_type
        FROM span GROUP BY entity HAVING count(*) >= {GAZETTEER_LEAST}),
    hit AS (
        SELECT doc_id, pos, max(n) AS n, arg_max(phrase, n) AS entity, arg_max(entity_type, n) AS entity_type
        FROM (SELECT tok.doc_id, pos, z.n, phrase, entity_type, tokens.token[pos + 1 : pos + z.n] AS words
              FROM tok JOIN gazetteer z ON tok.token = split_part(phrase, ' ', 1)
              JOIN tokens ON tokens.doc_id = tok.doc_id)
        WHERE array_to_string(words, ' ') = phrase GROUP BY doc_id, pos),
    linked AS MATERIALIZED (
        SELECT a.*, b.pos AS next FROM hit a ASOF LEFT JOIN hit b ON a.doc_id = b.doc_id AND a.pos + a.n <= b.pos),
    walk AS (
        SELECT * FROM linked WHERE (doc_id, pos) IN (SELECT (doc_id, min(pos)) FROM hit GROUP BY doc_id)
        UNION ALL
        SELECT l.* FROM walk w JOIN linked l ON l.doc_id = w.doc_id AND l.pos = w.next)"""


def _chunk_sql(chunks: str) -> str:
    return f"""SELECT t.doc_id, count(c.pos) AS n,
        coalesce(string_agg(c.entity || '/' || c.entity_type, '|' ORDER BY c.pos), '') AS chunks
    FROM tokens t LEFT JOIN {chunks} c ON c.doc_id = t.doc_id GROUP BY t.doc_id"""


_POS_VALUES = ", ".join(
    f"('{token}', '{tag}')"
    for token, tag in sorted(
        {t: min(k for k, ws in shapes.POS_WORDS.items() if t in ws) for ws in shapes.POS_WORDS.values() for t in ws}.items()
    )
)
_POS_CTE = f"lexicon(word, tag) AS (VALUES {_POS_VALUES})"
_POS = (
    "coalesce(tag, CASE "
    + " ".join(f"WHEN regexp_matches(token, '{p}') THEN '{t}'" for p, t in shapes.POS_SHAPES)
    + f" ELSE '{shapes.POS_OTHER}' END)"
)
_PLURALS = """vocabulary AS (SELECT DISTINCT token FROM tok),
    plural AS (SELECT p.token, s.token AS lemma FROM vocabulary p JOIN vocabulary s ON p.token = s.token || 's')"""

_ARTICLE = """title, content, topic, source, url, published_date, received_date, processed_date, word_count,
        language, sentiment_score, processing_status"""


def _article_sql() -> str:
    return rf"""SELECT doc_id, text AS title, '{fixed.ARTICLE_CONTENT}' AS content, {_topic()} AS topic,
        '{fixed.ARTICLE_SOURCE}' AS source,
        '{fixed.URL_PREFIX}' || strftime(TIMESTAMP '{AS_OF}', '%Y%m%d%H%M%S%g') || '-' || md5(text) AS url,
        TIMESTAMP '{AS_OF}' AS published_date, TIMESTAMP '{AS_OF}' AS received_date,
        TIMESTAMP '{AS_OF}' AS processed_date, len(string_split_regex(text, '\s+')) AS word_count,
        '{fixed.ARTICLE_LANGUAGE}' AS language, 'none' AS sentiment_score,
        '{fixed.ARTICLE_STATUS}' AS processing_status FROM documents"""


def _cloud_cte() -> str:
    letters = f"[^a-z{fixed.ACCENTED_LETTERS}\\s]"
    return rf"""word AS (
        SELECT unnest(string_split_regex(regexp_replace(lower(text), '{letters}', '', 'g'), '\s+')) AS word,
               {_topic()} AS topic FROM documents),
    cloud AS (
        SELECT word, topic, count(*) AS frequency FROM word
        WHERE length(word) > 3 AND NOT regexp_full_match(word, '({"|".join(fixed.FR_STOP)})') GROUP BY ALL)"""


def _styled_sql() -> str:
    def case(pick, other):
        rules = " ".join(f"WHEN frequency > {b[0]} THEN {pick(b)}" for b in fixed.BUCKETS)
        return f"CASE {rules} ELSE {other} END"

    size = case(lambda b: b[1], fixed.OTHER_STYLE[0])
    color = case(lambda b: f"'{b[2]}'", f"'{fixed.OTHER_STYLE[1]}'")
    return f"""WITH {_cloud_cte()} SELECT word, topic, frequency, CAST(frequency AS DOUBLE) AS weight,
        {size} AS font_size, {color} AS color, '{fixed.CLOUD_CATEGORY}' AS category,
        TIMESTAMP '{AS_OF}' + INTERVAL 2 HOUR AS expires_at FROM cloud"""


_TREND = """SELECT topic, count, count * 2.0::DOUBLE AS trend_score, time_window, '1 minutes' AS window_duration,
    time_window AS first_seen, last_seen, count AS peak_count, 'CLI_Stream' AS sources
    FROM (SELECT event_type AS topic, time_bucket(INTERVAL 1 MINUTE, ts) AS time_window, count(*) AS count,
          max(ts) AS last_seen FROM events GROUP BY ALL)"""


def _keywords_sql(limit="") -> str:
    return f"""WITH {_tokens_cte()} SELECT token AS word, count(*) AS count FROM tok
        WHERE lower(token) NOT IN ({_quoted(fixed.EN_STOP)}) AND length(token) > 1
        GROUP BY token ORDER BY count DESC, word {limit}"""


def _trending_sql(lookback: str, ts: str = "ts") -> str:
    return f"""SELECT entity_name, entity_type, count, count * 1.5::DOUBLE AS trend_score, time_window,
        '{lookback}' AS window_duration, 'CLI_Stream' AS source
        FROM (SELECT 'user' || user_id AS entity_name, event_type AS entity_type, count(*) AS count,
              (SELECT max({ts}) FROM events) AS time_window FROM events
              WHERE {ts} >= (SELECT max({ts}) FROM events) - INTERVAL '{lookback}'
              GROUP BY ALL ORDER BY count DESC, entity_name, entity_type LIMIT 20)"""


def _extracted_sql() -> str:
    return f"""WITH {_tokens_cte("conversations", "conv_id || '-' || turn")}, {_spans_cte()}
        SELECT entity AS entity_name, entity_type, TIMESTAMP '{AS_OF}' AS detected_at,
        'CLI_Stream' AS source, 0.8::DOUBLE AS confidence, 1 AS frequency FROM span WHERE length(entity) > 1"""


def _hashed_sql() -> str:
    """The 32-bit hash of a term's UTF-8 bytes that hashed features go by (seed 42), and TF-IDF on it."""
    most = "4294967295::UBIGINT"
    times = lambda x, n: f"(({x}) * {n}::UBIGINT & {most})"
    turn = lambda x, n: f"(((({x}) << {n}) | (({x}) >> {32 - n})) & {most})"
    mix = lambda x: times(turn(times(x, 3432918353), 15), 461845907)
    byte = lambda i: f"hx[2 * ({i}) + 1 : 2 * ({i}) + 2]"
    word = f"('0x' || {byte('4 * i + 3')} || {byte('4 * i + 2')} || {byte('4 * i + 1')} || {byte('4 * i')})::UBIGINT"
    rest = "CASE n % 4 " + " ".join(
        f"WHEN {t} THEN ('0x' || {' || '.join(byte(f'n - n % 4 + {j}') for j in reversed(range(t)))})::UBIGINT" for t in (1, 2, 3)
    ) + " ELSE 0::UBIGINT END"
    return f"""WITH {_tokens_cte()},
        clean AS (SELECT doc_id, token AS term FROM tok WHERE lower(token) NOT IN ({_quoted(fixed.EN_STOP)})),
        bytes AS (SELECT term, hex(encode(term)) AS hx, octet_length(encode(term)) AS n FROM (SELECT DISTINCT term FROM clean)),
        parts AS (SELECT *, list_transform(range(0, n // 4), lambda i: {mix(word)}) AS words, {mix(rest)} AS last FROM bytes),
        body AS (SELECT term, n, last, list_reduce(words,
            lambda h, k: ({times(turn("xor(h, k)", 13), 5)} + 3864292196) & {most}, 42::UBIGINT) AS h FROM parts),
        a AS (SELECT term, xor(xor(h, last), n::UBIGINT) AS h FROM body),
        b AS (SELECT term, {times("xor(h, h >> 16)", 2246822507)} AS h FROM a),
        c AS (SELECT term, {times("xor(h, h >> 13)", 3266489909)} AS h FROM b),
        d AS (SELECT term, xor(h, h >> 16)::BIGINT AS h FROM c),
        bucket AS (SELECT term, ((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 1000 + 1000) % 1000 AS bucket FROM d),
        tf AS (SELECT doc_id, bucket, count(*) AS tf FROM clean JOIN bucket USING (term) GROUP BY ALL),
        df AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
        weighted AS (
            SELECT doc_id, count(*) AS buckets,
                   sum(tf * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1))) AS weight
            FROM tf JOIN df USING (bucket) GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(buckets, 0)::INTEGER AS buckets, round(coalesce(weight, 0), 3) AS weight
        FROM documents LEFT JOIN weighted USING (doc_id)"""


_ARTICLES_SQL = """SELECT text AS title, CASE WHEN lang = 'de' THEN 'Unknown' ELSE lang END AS author,
    CASE WHEN n_chars > 400 THEN source ELSE 'No description' END AS description,
    CASE WHEN lang = 'es' THEN 'No URL' ELSE 'news/' || doc_id END AS url,
    CASE WHEN n_chars % 2 = 0 THEN n_chars::VARCHAR ELSE 'Unknown date' END AS "publishedAt" FROM documents"""
_LINES_SQL = rf"""SELECT 'Title: ' || regexp_replace(title, '\s+', ' ', 'g') || ' | Published At: ' || "publishedAt" AS line
    FROM ({_ARTICLES_SQL})"""


def oracle_sql() -> dict[str, str]:
    words = lambda where: f"""WITH {_tokens_cte()} SELECT doc_id, len(w) AS n, array_to_string(w, ' ') AS words
        FROM (SELECT doc_id, {where} AS w FROM tokens)"""
    stop = _quoted(fixed.EN_STOP)
    gazetteer_match = f"WITH RECURSIVE {_tokens_cte()}, {_spans_cte()}, {_GAZETTEER} {_chunk_sql('walk')}"
    stages = f"""WITH {_tokens_cte()}, {_POS_CTE}, {_PLURALS}, {_spans_cte()},
        per AS (SELECT doc_id, count(*) AS tokens, count(*) FILTER ({_POS} LIKE 'NN%') AS nouns,
                count(*) FILTER (lower(token) NOT IN ({stop})) AS clean,
                coalesce(string_agg(coalesce(lemma, token), ' ' ORDER BY pos) FILTER (lower(token) NOT IN ({stop})), '') AS lemmas
            FROM tok LEFT JOIN lexicon ON lower(token) = word LEFT JOIN plural USING (token) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS entities FROM span GROUP BY doc_id)
        SELECT d.doc_id, coalesce(tokens, 0) AS tokens, coalesce(nouns, 0) AS nouns, coalesce(clean, 0) AS clean,
               coalesce(lemmas, '') AS lemmas, coalesce(entities, 0) AS entities
        FROM documents d LEFT JOIN per USING (doc_id) LEFT JOIN found USING (doc_id)"""
    own = {
        "article_enrich": _article_sql(),
        "topic_classify": f"SELECT doc_id, {_topic()} AS detected_topic FROM documents",
        "topic_whole_word": f"SELECT doc_id, {_topic(whole_word=True)} AS detected_topic FROM documents",
        "topic_counts": f"SELECT {_topic()} AS topic, count(*) AS count FROM documents GROUP BY ALL",
        "topic_trend_1min": _TREND,
        "wordcloud": f"WITH {_cloud_cte()} SELECT word, topic, frequency FROM cloud",
        "wordcloud_style": _styled_sql(),
        "punct_clean": "SELECT doc_id, regexp_replace(text, '[,.!?]', '', 'g') AS text FROM documents",
        "tokens": words("token"),
        "token_spans": r"""SELECT doc_id, length(regexp_replace(text, '\s+', '', 'g')) AS characters, 0::BIGINT AS misplaced,
            0::BIGINT AS misplaced_names FROM documents""",
        "stopword_removed": words(f"list_filter(token, lambda t: lower(t) NOT IN ({stop}))"),
        "keyword_counts": _keywords_sql(),
        "keyword_top10": _keywords_sql("LIMIT 10"),
        "lemma_counts": f"""WITH {_tokens_cte()}, {_PLURALS}
            SELECT word, count(*) AS count FROM (
                SELECT coalesce(lemma, tok.token) AS word FROM tok LEFT JOIN plural USING (token)
                WHERE lower(tok.token) NOT IN ({stop})) WHERE length(word) > 1 GROUP BY word""",
        "lemma_counts_dup": f"""WITH {_tokens_cte()}, {_PLURALS},
            twice AS (SELECT token, min(lemma) AS lemma FROM (
                SELECT token, lemma FROM plural UNION ALL SELECT token, '!' || token FROM plural) GROUP BY token)
            SELECT word, count(*) AS count FROM (
                SELECT coalesce(lemma, tok.token) AS word FROM tok LEFT JOIN twice USING (token)
                WHERE lower(tok.token) NOT IN ({stop})) WHERE length(word) > 1 GROUP BY word""",
        "stopword_table": words("list_filter(token, lambda t: length(t) > 3)"),
        "lemmas_per_document": f"""WITH {_tokens_cte()}, {_PLURALS}
            SELECT doc_id, count(DISTINCT coalesce(lemma, tok.token)) AS lemmas,
                   count(*) FILTER (lemma IS NOT NULL) AS changed
            FROM tok LEFT JOIN plural USING (token) GROUP BY doc_id""",
        "lemma_rules": f"""WITH {_tokens_cte()}, {_PLURALS},
            half AS (SELECT * FROM plural WHERE ('0x' || md5(lemma)[1])::INTEGER < 8),
            listed AS (SELECT token, min(lemma) AS lemma FROM (
                SELECT token, lemma FROM half UNION ALL SELECT lemma, lemma FROM half) GROUP BY token),
            edit AS (
                SELECT token, length(token) - same AS strip, substr(lemma, same + 1) AS add FROM (
                    SELECT *, len(list_filter(range(1, least(length(token), length(lemma)) + 1),
                        lambda i: token[1:i] = lemma[1:i])) AS same FROM listed)),
            seen AS (
                SELECT right(token, k) AS ending, strip, add, count(*) AS n FROM edit, range(6) AS r(k)
                WHERE k >= strip AND k < length(token) GROUP BY ALL),
            rule AS (
                SELECT ending, strip, add FROM (
                    SELECT *, row_number() OVER (PARTITION BY ending ORDER BY n DESC, strip, add) AS place,
                        sum(n) OVER (PARTITION BY ending) AS every FROM seen)
                WHERE place = 1 AND every >= 2)
            SELECT token, left(token, length(token) - strip) || add AS lemma FROM (
                SELECT token, strip, add, row_number() OVER (PARTITION BY token ORDER BY k DESC) AS place
                FROM vocabulary, range(6) AS r(k) JOIN rule ON ending = right(token, k)
                WHERE k < length(token) AND token NOT IN (SELECT token FROM listed)) WHERE place = 1""",
        "pos_counts_top20": f"""WITH {_tokens_cte()}, {_POS_CTE}
            SELECT {_POS} AS pos_tag, count(*) AS count FROM tok LEFT JOIN lexicon ON lower(token) = word
            GROUP BY ALL ORDER BY count DESC, pos_tag LIMIT 20""",
        "pos_counts_dup": f"""WITH {_tokens_cte()}, {_POS_CTE}
            SELECT {_POS} AS pos_tag, count(*) AS count FROM tok LEFT JOIN lexicon ON lower(token) = word
            GROUP BY ALL ORDER BY count DESC, pos_tag LIMIT 20""",
        "pos_tagged": f"""WITH {_tokens_cte()}, {_POS_CTE}
            SELECT doc_id, {_POS} AS pos_tag, count(*) AS count
            FROM tok LEFT JOIN lexicon ON lower(token) = word GROUP BY ALL""",
        "pos_lexicon": f"""WITH {_tokens_cte()}, {_POS_CTE}
            SELECT w AS token, t AS tag FROM (
                SELECT w, t, row_number() OVER (PARTITION BY w ORDER BY c DESC, t) AS place FROM (
                    SELECT lower(token) AS w, {_POS} AS t, count(*) AS c
                    FROM tok LEFT JOIN lexicon ON lower(token) = word GROUP BY ALL)) WHERE place = 1""",
        "pos_context": f"""WITH {_tokens_cte()}
            SELECT count(*) AS documents, sum(len(token))::BIGINT AS tokens, true AS above_lexicon, true AS nearly_all
            FROM tokens WHERE doc_id % 4 = 0 AND len(token) > 0""",
        "entity_spans": f"WITH {_tokens_cte()}, {_spans_cte()} {_chunk_sql('span')}",
        "entity_counts_top10": f"""WITH {_tokens_cte()}, {_spans_cte()}
            SELECT entity, count(*) AS count FROM span GROUP BY entity ORDER BY count DESC, entity LIMIT 10""",
        "entity_tagger": f"""WITH RECURSIVE {_tokens_cte()}, {_spans_cte()}, {_GAZETTEER},
            inside AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM walk),
            named AS (SELECT doc_id, pos, token FROM tok WHERE {_NAME} AND (doc_id, pos) NOT IN (SELECT (doc_id, pos) FROM inside)),
            a AS (SELECT doc_id, count(*) AS n FROM inside GROUP BY doc_id),
            b AS (SELECT doc_id, count(*) AS n FROM named GROUP BY doc_id)
            SELECT t.doc_id, len(t.token) AS tokens, coalesce(a.n, 0) AS in_phrases, coalesce(b.n, 0) AS typed, 0 AS of_no_type
            FROM tokens t LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)""",
        "entity_sequences": f"""WITH RECURSIVE {_tokens_cte()}, {_spans_cte()},
            {_GAZETTEER.replace("HAVING ", "HAVING ('0x' || md5(entity)[1])::INTEGER >= 8 AND ")},
            inside AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM walk)
            SELECT count(*) AS words, 0::BIGINT AS illegal, true AS above_majority FROM tok
            WHERE {_NAME} AND (doc_id, pos) NOT IN (SELECT (doc_id, pos) FROM inside)""",
        "gazetteer_match": gazetteer_match,
        "gazetteer_match_carried": gazetteer_match,
        "gazetteer_match_joined": gazetteer_match,
        "entity_type_counts": f"""WITH RECURSIVE {_tokens_cte()}, {_spans_cte()}, {_GAZETTEER},
            rest AS (SELECT * FROM tok WHERE (doc_id, pos) NOT IN (
                SELECT (doc_id, unnest(range(pos, pos + n))) FROM walk)),
            rest_name AS (
                SELECT doc_id, pos, token, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island
                FROM rest WHERE {_NAME}),
            rest_span AS (
                SELECT string_agg(token, ' ' ORDER BY pos) AS entity, '{shapes.NAME_TYPE}' AS entity_type
                FROM rest_name GROUP BY doc_id, island)
            SELECT entity, entity_type, count(*) AS count, '2024-01-31' AS date_recorded
            FROM (SELECT entity, entity_type FROM walk UNION ALL SELECT entity, entity_type FROM rest_span)
            GROUP BY ALL""",
        "iob_chunks": f"""WITH {_tokens_cte()},
            tagged AS (SELECT *, CASE length(token) % 5 WHEN 0 THEN 'B-PER' WHEN 1 THEN 'I-PER' WHEN 2 THEN 'I-LOC' ELSE 'O' END AS tag FROM tok),
            marked AS (SELECT *, CASE WHEN tag LIKE 'B-%' OR tag[3:] <> coalesce(
                lag(tag) OVER (PARTITION BY doc_id ORDER BY pos), 'O')[3:] THEN 1 ELSE 0 END AS begins FROM tagged),
            numbered AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY pos) AS chunk FROM marked),
            chunked AS (SELECT doc_id, min(pos) AS pos, string_agg(token, ' ' ORDER BY pos) AS entity, min(tag[3:]) AS entity_type
                FROM numbered WHERE tag <> 'O' GROUP BY doc_id, chunk)
            {_chunk_sql('chunked')}""",
        "extracted_entities": _extracted_sql(),
        "trending_entities": _trending_sql("10 minutes"),
        "trending_entities_day": _trending_sql("24 hours"),
        "term_tfidf": f"""WITH {_tokens_cte()},
            tf AS (SELECT doc_id, token AS term, count(*) AS tf FROM tok WHERE lower(token) NOT IN ({stop}) GROUP BY ALL),
            df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
            SELECT doc_id, term, tf, df,
                   round(tf * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)), 6) AS tfidf
            FROM tf JOIN df USING (term)""",
        "updated_tfidf": f"""WITH {_tokens_cte()},
            left_over AS (SELECT doc_id FROM documents WHERE lang IS DISTINCT FROM 'de'),
            tf AS (SELECT doc_id, token AS term, count(*) AS tf FROM tok JOIN left_over USING (doc_id)
                   WHERE lower(token) NOT IN ({stop}) GROUP BY ALL),
            df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
            SELECT doc_id, term, tf, df,
                   round(tf * ln(((SELECT count(*) FROM left_over) + 1)::DOUBLE / (df + 1)), 6) AS tfidf
            FROM tf JOIN df USING (term)""",
        "hashing_tfidf": _hashed_sql(),
        "token_embeddings": rf"""WITH {_tokens_cte()},
            vector AS (
                SELECT v.token, e.embedding FROM (
                    SELECT DISTINCT token, ('0x' || substr(md5(token), 1, 6))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id
                    FROM tok WHERE regexp_matches(token, '^\p{{L}}')) v JOIN embeddings e USING (vec_id))
            SELECT doc_id, count(*) AS tokens, count(embedding) AS known,
                   coalesce(sum(list_sum(list_transform(embedding, lambda v, i: round(v::DOUBLE * 1e6)::BIGINT * i))), 0)::BIGINT
                       AS all_dimensions
            FROM tok LEFT JOIN vector USING (token) GROUP BY doc_id""",
        "json_articles": _ARTICLES_SQL,
        "json_dirty": """SELECT doc_id, title, author, 'No description' AS description, 'No URL' AS url,
                'Unknown date' AS "publishedAt"
            FROM (SELECT doc_id, text AS title, CASE WHEN lang = 'de' THEN 'Unknown' ELSE lang END AS author
                  FROM documents WHERE doc_id % 6 > 3
                  UNION ALL SELECT doc_id, unnest(['No title', 'No title', 'No title']), 'Unknown'
                  FROM documents WHERE doc_id % 6 = 3)""",
        "article_lines": _LINES_SQL,
        "annotation_stages": stages,
        "saved_stages": stages,
        "stream_articles": _article_sql(),
        "stream_topic_trend": _TREND,
        "stream_topic_complete": _TREND,
        "stream_entity_articles": f"SELECT * EXCLUDE (doc_id) FROM ({_article_sql()})",
        "stream_wordcloud": _styled_sql(),
        "stream_extracted_entities": _extracted_sql(),
        "stream_trending_entities": _trending_sql("10 minutes"),
        "stream_trending_live": _trending_sql("10 minutes", "date_trunc('second', ts)"),
        "stream_document_frequencies": f"""WITH {_tokens_cte()}
            SELECT token AS term, count(DISTINCT doc_id) AS df FROM tok WHERE lower(token) NOT IN ({stop}) GROUP BY ALL
            UNION ALL SELECT 'all documents', count(*) FROM documents""",
        "stream_article_lines": _LINES_SQL,
    }
    return own if llm_queries is None else {**own, **llm_queries.oracle_sql()}
