"""Streams of the registered queries over tables that are one file or a folder of files."""

import glob
import shutil

import pytest

import __spark_entry__ as registered

PAIRS = (
    ("stream_articles", "article_enrich"), ("stream_extracted_entities", "extracted_entities"),
    ("stream_wordcloud", "wordcloud_style"),
)


@pytest.fixture(scope="module", params=["file", "folder"])
def tables(spark, tmp_path_factory, request):
    base = tmp_path_factory.mktemp(request.param)
    rows = [(i, f"Berlin wins the match {i % 3} and Paris votes", "en", "a", 10) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("documents", documents), ("conversations", documents.select("text"))):
        if request.param == "folder":
            df.repartition(3).write.parquet(f"{base}/{name}.parquet")
        else:
            df.coalesce(1).write.parquet(f"{base}/written-{name}")
            shutil.copy(glob.glob(f"{base}/written-{name}/part-*.parquet")[0], f"{base}/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("stream, batch", PAIRS)
def test_stream_reads_the_whole_table(spark, tables, stream, batch):
    found, expected = registered.queries()[stream](spark, tables), registered.queries()[batch](spark, tables)
    columns = [c for c in found.columns if c in expected.columns]
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(found) == rows(expected) != []


def test_stream_of_frequencies(spark, tables):
    counted = registered.queries()["stream_document_frequencies"](spark, tables)
    assert counted.where("term = 'Berlin'").select(counted.columns[-1]).first()[0] == 40
