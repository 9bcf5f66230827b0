import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsloom.llm import line_frequency
from newsloom.llm.line_frequency import clean_documents, line_rules, measured, repeated_words
from newsloom.llm.site_quality import NAMES, good_documents, site_quality, with_measures


def test_repeated_words_by_hand():
    assert repeated_words("a b c d") == 0
    assert repeated_words("a b c d e") == 0
    assert repeated_words("a b c d e a b c d e") == 10
    assert repeated_words("a b c d e x a b c d e") == 10
    assert repeated_words("a a a a a a") == 6


def _brute(text):
    words = text.encode().split()
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    marked = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            marked.update(range(i, i + 5))
    return len(marked)


def test_repeated_words_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))
        assert repeated_words(text) == _brute(text)


def test_measures_by_hand():
    text = "Same line\nsame  LINE\nSame line\n\n #é* x|\n"
    words, chars, symbols, dup, repeated, lines, line_words = measured(text)
    assert (words, symbols, dup, repeated) == (7, 3, 1, 0)
    assert chars == len("SamelinesameLINESameline#é* x|")
    assert len(lines) == 2 and sum(line_words) == 7


def test_lines_of_many_documents_of_a_host(docs):
    def own(i):
        return " ".join(f"w{i}x{j}" for j in range(12))

    shared = "this line is in very many documents of one host only it seems"
    rows = [(i, f"{shared.upper()}\n{own(i)}", "a") for i in range(40)]
    rows += [(100 + i, f"{shared}\n" * 2, "a") for i in range(5)]  # nothing else
    rows += [(200 + i, f"{own(200 + i)}", "a") for i in range(30)]
    rows += [(300 + i, f"{shared}", "b") for i in range(15)]  # not over the limit there
    found = {r.doc_id: r for r in line_rules(docs(*rows)).collect()}
    assert all(found[i].kept and found[i].left_words == 12 for i in range(40))
    assert all(not found[100 + i].kept and found[100 + i].left_words == 0 for i in range(5))
    assert all(found[200 + i].kept for i in range(30))
    assert all(found[300 + i].kept and found[300 + i].left_words == 13 for i in range(15))


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").withColumnRenamed("quality", "label")
    rows = site_quality(documents, fit).join(held, "doc_id").collect()
    assert len(rows) > 150
    assert sum(r.kept == (r.label == 1) for r in rows) >= 0.97 * len(rows)


def test_sparse_sites_follow_their_parents(docs, spark):
    good = "some ordinary words of a text that reads well number "
    rows = [(i, good + str(i), "good", "p") for i in range(300)]
    rows += [(1000 + i, "| ".join(["x#"] * 30) + str(i), "bad", "p") for i in range(300)]
    rows += [(2000, good, "good", "rare"), (2001, good, "bad", "rare"), (2002, good, "new", "p")]
    given = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[2] == "good")) for r in rows[:600:2]], "doc_id long, quality int")
    found = {r.doc_id: r for r in site_quality(given, labels).collect()}
    assert found[2000].path_share > found[2002].path_share > found[2001].path_share
    assert found[2000].quality >= found[2002].quality > found[2001].quality
    kept = {r.doc_id for r in good_documents(given, labels).collect()}
    assert kept >= set(range(300)) and not kept & set(range(1000, 1300))


def test_measures_run_through_a_text_once(odd):
    """Measures against plain ones; the text is cut into words once, and characters are counted in what is cut out."""
    found = with_measures(odd.select("text", "source", F.col("text").alias("kept")), before="")
    for r in found.collect():
        text = r.kept or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [line for line in text.split("\n") if line.strip(" ")]
        share = lambda signs: sum(text.count(c) for c in signs) / max(len(text), 1)
        unlike = lambda items: 1 - len(set(items)) / len(items) if items else 0.0
        plain = [share("#*$%&|<>"), share("|"), share("!"), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"), unlike(words),
                 unlike(lines), math.log1p(len(words)), len(text) / len(words) if words else 0.0, unlike(words) * math.log1p(len(words))]
        assert [r[name] for name in NAMES] == pytest.approx(plain)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count("split(") == 2 and "translate(coalesce" not in plan


def test_without_labels_all_stay(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    given = docs((1, "| | |"), (2, "fine words"))
    assert good_documents(given, none).count() == 2


def test_many_lines_over_the_limit_are_joined(docs, monkeypatch):
    """Lines over the limit, one in most documents: broadcast or joined, and for a null host."""
    rng = random.Random(3)
    lines = [f"line {i} of some more words" for i in range(60)]
    rows = [
        (i % 300, "\n".join(["a line in all documents", *rng.sample(lines, 9), f"own {i}"]), rng.choice(["a", None]))
        for i in range(400)
    ]
    given = docs(*rows).repartition(5)
    found = sorted(map(tuple, line_rules(given).collect()))
    monkeypatch.setattr(line_frequency, "BROADCAST_LINES", 0)
    assert found == sorted(map(tuple, line_rules(given).collect()))
    counts = Counter((host, line) for _, text, host in rows for line in text.split("\n"))
    left = sorted((i, sum(len(x.split()) for x in text.split("\n") if counts[host, x] <= 20)) for i, text, host in rows)
    assert left == sorted((r[0], r[-1]) for r in found)


def test_cleaned_texts_have_the_words_that_are_left(spark, docs, odd, empty):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    verdicts = {r.doc_id: r for r in line_rules(given, max_docs=2).collect()}
    cleaned = clean_documents(given, max_docs=2)
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert cleaned.columns == given.columns and set(texts) == {i for i, r in verdicts.items() if r.kept}
    assert all(len(text.encode().split()) == verdicts[i].left_words for i, text in texts.items())
    assert any(verdicts[i].left_words < verdicts[i].n_words for i in texts)
    own = " ".join(f"w{j}" for j in range(12))
    rows = [(i, f"Shared  line\n\n{own} {i}\nshared LINE", "a") for i in range(30)] + [(99, "shared line\n" * 9, "a")]
    left = clean_documents(docs(*rows, rows[0])).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted((i, f"\n{own} {i}") for i in [0, *range(30)])
    assert clean_documents(odd).schema == odd.schema and clean_documents(odd).count() == line_rules(odd).where("kept").count()
    assert clean_documents(empty).collect() == []


def test_posteriors_against_plain_ones(spark):
    """Shares and combined quality worked out in plain Python from each document's evidence."""
    sf = "/root/testdata/sf0.01"
    given, marks = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    labels = {}
    for r in marks.collect():
        labels[r.doc_id] = min(labels.get(r.doc_id, r.quality), r.quality)
    found = {r.doc_id: r for r in site_quality(given, marks).collect()}
    sites = {r.doc_id: (r.source, r.lang) for r in given.select("doc_id", "source", "lang").collect()}
    good = {i: labels.get(i, r.evidence) for i, r in found.items()}

    def sums(key):
        out = {}
        for i, site in sites.items():
            s, n = out.get(key(site), (0.0, 0))
            out[key(site)] = s + good[i], n + 1
        return out

    def strength(table, prior):
        spread = sum(n * (s / n - prior(k)) ** 2 for k, (s, n) in table.items())
        noise = sum(prior(k) * (1 - prior(k)) for k in table)
        most = sum(n * prior(k) * (1 - prior(k)) for k, (_, n) in table.items())
        excess = (spread - noise) / most
        return min(max(1 / excess - 1, 1.0), 1e6) if excess > 1e-6 else 1e6

    hosts, paths = sums(lambda site: site[0]), sums(lambda site: site)
    overall = (sum(good.values()) + 1) / (len(good) + 2)
    k = strength(hosts, lambda _: overall)
    host_share = {h: (k * overall + s) / (k + n) for h, (s, n) in hosts.items()}
    k = strength(paths, lambda path: host_share[path[0]])
    path_share = {p: (k * host_share[p[0]] + s) / (k + n) for p, (s, n) in paths.items()}
    logit = lambda p: math.log(p / (1 - p))
    for i, r in found.items():
        host, path = host_share[sites[i][0]], path_share[sites[i]]
        assert r.host_share == pytest.approx(host, abs=1e-4) and r.path_share == pytest.approx(path, abs=1e-4)
        if 1e-4 < r.evidence < 1 - 1e-4:  # beyond, the rounded evidence does not tell its logit
            both = 1 / (1 + math.exp(-(logit(r.evidence) + logit(path) - logit(overall))))
            assert r.quality == pytest.approx(both, abs=5e-3)
            assert r.kept == (r.quality >= 0.3)
