"""Python workers only have Spark and Arrow: nothing sent to them may import this package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from newsloom.operators import flatten_articles, lemma_arrays, match_phrases, to_messages
from newsloom.session import session

spark = session(**{
    "spark.master": "local[2]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "2",
})
titles = spark.createDataFrame([("a",), ("b",)], "title string")
assert flatten_articles(to_messages(titles)).count() == 2
words = spark.sql("select array('cars', 'x') as token")
lexicon = spark.sql("select 'cars' as token, 'car' as lemma")
assert lemma_arrays(words, lexicon).first().lemma == ["car", "x"]
gazetteer = spark.sql("select 'cars x' as phrase, 'T' as entity_type")
assert match_phrases(words, gazetteer).first().ner == ["B-T", "I-T"]
print("fine")
"""


def test_workers_need_not_have_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=170
    )
    assert "fine" in done.stdout, done.stderr[-2000:]
