"""The registered queries against SQL, brute force and each other, on whole tables."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_all_operators_are_registered():
    assert {name.split("_")[0] for name in llm.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(llm.oracle_sql()) < set(llm.queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, tables, name):
    df = llm.queries()[name](spark, SF)
    result = tables.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _sorted(df.columns, df.collect()) == _sorted(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql()) - {"op3_packing"}))
def test_a_row_for_each_document(spark, name):
    df = llm.queries()[name](spark, SF)
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == list(range(200))


def test_token_counts_and_files_agree(spark):
    counts = {r.doc_id: r.n_tokens for r in llm.queries()["op7_token_counts"](spark, SF).collect()}
    files = {r.doc_id: r.n_tokens for r in llm.queries()["op5_token_files"](spark, SF).collect()}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in llm.documents(spark, SF).collect():
        n = len(whole.encode(r.text, add_special_tokens=False).ids)
        assert counts[r.doc_id] == n and files[r.doc_id] == n + 1


def test_pipeline_stage_by_stage(spark, tables):
    """Each stage on what the stage before kept, against a plain rule for what it has to do."""
    docs = llm.documents(spark, SF)
    kept = [docs.select("doc_id", "text", "source").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.saved(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        kept.append(docs.select("doc_id", "text", "source").collect())
    start, good, single, apart, mix = kept
    labels = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    gone = {r.doc_id for r in start} - {r.doc_id for r in good}
    assert gone and sum(labels.get(i, 0) for i in gone) <= 1
    normal = lambda text: " ".join(text.encode().decode().split())
    first = {}
    for r in good:
        key = normal(r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in single} == set(first.values())

    def grams(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    sets = [grams(r.text) for r in apart]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert len(a & b) < 0.8 * max(1, len(a | b))
    assert {r.doc_id for r in apart} <= {r.doc_id for r in single}
    words = sum(len(r.text.split()) for r in apart)
    assert words - 20 <= sum(len(r.text.split()) for r in mix) <= words
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(whole.encode(r.text, add_special_tokens=False).ids) + 1 for r in mix)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert pieces["length"].sum() == tokens
    used = pieces.groupby("sequence_id")["length"].sum().to_numpy()
    assert np.all((used == 2048) | (used & (used - 1) == 0))


def test_the_run_is_its_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "packing"]
    assert corpus_pipeline.run(spark, SF).columns[0] == "doc_id"
