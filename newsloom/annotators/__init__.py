from .stages import (
    Chunker, Embedder, EntityTagger, Finisher, Lemmatizer, PosTagger, StopWords, TextAssembler, Tokenizer,
    build_pipeline, news_stages,
)

__all__ = [
    "Chunker", "Embedder", "EntityTagger", "Finisher", "Lemmatizer", "PosTagger", "StopWords",
    "TextAssembler", "Tokenizer", "build_pipeline", "news_stages",
]
