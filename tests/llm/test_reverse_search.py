"""Reversed search against a plain loop over all documents and items."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from newsloom.llm.reverse_search import Index, Scorer, index_items, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [(1, "the same words"), (2, "WORDS words été"), (2, None), (None, "--"), (3, "nothing like it here zzz"), (4, "words")]


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    rows = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in docs]
    count, total = sum(n > 0 for *_, n in rows), sum(n for *_, n in rows)
    df = Counter(t for _, tf, _ in rows for t in tf)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, tf, n in rows:
            m = 25 + (75 * n * count) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in terms(text) if tf[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if null else doc_id, -score) for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("item_bytes", [200, 16 << 20])
@pytest.mark.parametrize("k", [2, 10])
def test_against_a_loop(spark, odd, item_bytes, k):
    """Nulls, empty and long texts, ties and repeated rows; items in one block or in some."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = search(odd.repartition(5), items, k, item_bytes=item_bytes)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, ITEMS, k)


def test_without_documents_or_items(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search(empty, items).collect() == []
    assert search(odd, items.limit(0)).collect() == []


def test_terms():
    text = "Été ÉTÉ a_B x\x7fy ß٣ İ\x00z"
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)


def test_scores_are_exact_above_what_floats_hold():
    index = index_items([(1, "a " * 3), (2, "a b")])
    assert isinstance(index, Index)
    scorer = Scorer(index, np.array([2**40 + 1, 2**41 + 3], np.int64), 2, 8)
    found = scorer.scores([4, 4], np.array([0, 2, 3]), np.array([0, 1, 1]), np.array([3, 1, 1]))
    m = 25 + (75 * 4 * 2) // 8
    q = lambda tf: (10**9 * tf) // (1000 * tf + 8 * m)
    assert found.tolist() == [
        [3 * (2**40 + 1) * q(3), (2**40 + 1) * q(3) + (2**41 + 3) * q(1)], [0, (2**41 + 3) * q(1)],
    ]
