import re

import pytest
from hypothesis import given, settings, strategies as st

from newsloom.operators import TokenRules, chunk_spans, token_spans
from newsloom.operators.offsets import _cutter


@pytest.mark.parametrize("text, tokens", [
    ("He said (\"yes\").", ["He", "said", "(", '"', "yes", '"', ")", "."]),
    ("The U.S. is big, e.g. Texas.", ["The", "U.S.", "is", "big", ",", "e.g.", "Texas", "."]),
    ("Anna's dog...and/or cats", ["Anna", "'s", "dog", "...", "and", "/", "or", "cats"]),
    ("5% of $3.50 -- état-major", ["5", "%", "of", "$", "3.50", "--", "état-major"]),
    ("  ", []), ("", []), ("?!", ["?", "!"]), ("(U.S.)", ["(", "U.S.", ")"]),
])
def test_tokens(texts, text, tokens):
    (row,) = token_spans(texts(text)).collect()
    assert [s.token for s in row.spans] == tokens
    assert all(text[s.begin:s.end] == s.token for s in row.spans)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB9.é'\"()$-/…=🙂s,:"), min_size=1, max_size=15))
def test_every_character_is_in_one_token(piece):
    spans = _cutter(TokenRules())(piece)
    assert [i for begin, end in spans for i in range(begin, end)] == list(range(len(piece)))


def test_places_are_characters(spark, texts):
    df = token_spans(texts("🙂 é, 中文!", None, ""))
    rows = df.selectExpr("doc_id", "spans", "transform(spans, s -> substring(text, s.begin + 1, s.end - s.begin)) as there").orderBy("doc_id").collect()
    assert rows[0].there == [s.token for s in rows[0].spans] == ["🙂", "é", ",", "中文", "!"]
    assert rows[1].spans is None and rows[2].spans == []


def test_other_rules(texts):
    rules = TokenRules(prefixes=(), suffixes=(), infixes=("-",), exceptions=("x-y",))
    (row,) = token_spans(texts("a-b X-Y c."), rules=rules).collect()
    assert [s.token for s in row.spans] == ["a", "-", "b", "X-Y", "c."]


def test_chunks_have_spans(spark, texts):
    df = token_spans(texts("In New  York, Paris met Anna"))
    tags = ["O", "B-LOC", "I-LOC", "O", "I-LOC", "O", "B-PER"]
    from pyspark.sql import functions as F

    (row,) = chunk_spans(df.withColumn("ner", F.array(*map(F.lit, tags)))).collect()
    assert [tuple(c) for c in row.chunks] == [("New  York", "LOC", 3, 12), ("Paris", "LOC", 14, 19), ("Anna", "PER", 24, 28)]


def test_slices_of_a_batch(spark, monkeypatch):
    """However a batch is sliced, and whatever stands at the edges of its texts, the tokens are the same."""
    from newsloom.operators import offsets, texts_at
    from pyspark.sql import functions as F

    rows = ["ab", "cd ", " ef", "", None, "🙂x, (é)", "\u00a0y\u2003z", " \t\n ", "中文... b", "end."] * 3
    want = [None if t is None else [(t[b + at.start():e + at.start()], b + at.start(), e + at.start())
            for at in re.compile(r"\S+", re.ASCII).finditer(t) for b, e in _cutter(TokenRules())(at.group())] for t in rows]
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(offsets, "_SLICE_BYTES", size)
        df = token_spans(spark.createDataFrame(list(enumerate(rows)), "id int, text string").coalesce(1))
        found = {r.id: r.spans for r in df.collect()}
        assert [found[i] and [tuple(s) for s in found[i]] if found[i] else found[i] for i in range(len(rows))] == want
        there = texts_at(df.withColumns({"b": F.col("spans.begin"), "e": F.col("spans.end")}), "text", "b", "e", "there")
        assert all(r.there == (r.spans and [s.token for s in r.spans]) if r.spans else r.there == r.spans for r in there.collect())
    odd = spark.createDataFrame([("héllo", [-2, 3, 1, None, 4], [5, 1, 99, 2, None]), ("ab", [0], None), (None, [0], [1])], "text string, b array<int>, e array<int>")
    assert [r.there for r in texts_at(odd.coalesce(1), "text", "b", "e", "there").collect()] == [["lo", "", "éllo", "hé", "o"], None, None]


def test_a_batch_is_handed_back_in_slices(spark, monkeypatch):
    """What is held of a batch of 5 MB of text is of a slice, not of all its tokens."""
    import tracemalloc

    import pyarrow as pa

    from newsloom.operators import offsets

    made = {}
    monkeypatch.setattr(offsets, "_SLICE_BYTES", 1 << 18, raising=False)
    monkeypatch.setattr(offsets.F, "arrow_udf", lambda kind: lambda f: made.update(f=f) or (lambda *c: None))
    monkeypatch.setattr(offsets, "settle", lambda df, *a: df)
    token_spans(type("Table", (), {"withColumn": lambda self, *a: self})(), "text")
    texts = pa.array(["The (quick) brown fox, it ran " * 100] * 1700)
    tracemalloc.start()
    sizes = [len(found.values) for found in made["f"](iter([texts]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 1700 * 900 and max(sizes) < 100_000 and peak < 70e6
