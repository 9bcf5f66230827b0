"""A corpus made ready for training, stage by stage: judge, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a table
that is written and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.llm.common import saved
from newsloom.llm.curriculum import mixed
from newsloom.llm.dart_minhash import drop_near_copies
from newsloom.llm.exact_dedup import drop_copies
from newsloom.llm.queries import documents, packed
from newsloom.llm.site_quality import good_documents


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark, docs, sf_dir):
    """One document of each text."""
    return drop_copies(docs)


def near(spark, docs, sf_dir):
    """One document of each class of near copies."""
    return drop_near_copies(docs)


def mix(spark, docs, sf_dir):
    """The training stream by the sources' weights; documents may come up to three times."""
    return mixed(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark, docs, sf_dir):
    """The pieces of all training sequences."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mix),
    ("packing", packing),
]

#: The stages use trained models, hashes and vocabularies that SQL does not have.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the documents of `sf_dir`, each written to the shared scratch folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
