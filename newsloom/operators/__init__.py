from .chunks import iob_to_chunks
from .enrich import ARTICLE_COLUMNS, enrich_articles
from .entities import (
    annotate_entities, entity_counts, entity_pairs, entity_type_counts, extract_entities, rank_trend, trending_entities,
)
from .frequencies import frequency_changes, inverse_frequencies, merge_frequencies, weigh_terms
from .keywords import keyword_counts, pos_frequencies, token_counts
from .lemma_rules import guess_lemmas, train_lemma_rules
from .lexicon import (
    embed, lemma_arrays, lemmatize, lookup, normalize_lexicon, pos_tag, pos_words, tag_arrays, train_pos_lexicon, vector_arrays,
)
from .messages import article_lines, flatten_articles, to_messages
from .offsets import TokenRules, chunk_spans, texts_at, token_spans
from .perceptron import ContextTagger, tag_in_context, train_context_tagger
from .phrases import match_phrases, ner_tag, normalize_gazetteer, prepare_gazetteer
from .tagger import EntityTagger, tag_entities, train_entity_tagger, typed_names
from .tfidf import hashing_tf, idf, term_frequencies, term_tfidf, tfidf
from .tokens import assemble, drop_stopwords, finish, remove_stopwords, token_rows, tokenize
from .topics import classify_topic, topic_counts, topic_trends
from .wordcloud import style_words, unexpired, word_cloud, word_frequencies

__all__ = [name for name in dir() if not name.startswith("_")]
