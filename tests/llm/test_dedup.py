import hashlib
import random
from collections import Counter

import numpy as np

from newsloom.llm.components import components
from newsloom.llm.dart_minhash import cells_of, drop_near_copies, linked, near_dedup, shingles, signature, similarity
from newsloom.llm.exact_dedup import CuckooIndex, build_index, digest_of, drop_copies, exact_dedup, update_index


def _digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_cuckoo_index_is_a_set():
    """Random insertions and deletions against a plain set, through many resizes."""
    index, live, rng = CuckooIndex(2), set(), random.Random(5)
    for _ in range(20_000):
        i = rng.randrange(4_000)
        if i in live and rng.random() < 0.45:
            assert index.delete(_digest(i))
            live.discard(i)
        elif index.find(_digest(i)) is None:
            assert i not in live
            index.insert([_digest(i), i])
            live.add(i)
        else:
            assert i in live
    assert index.count == len(live) == len(list(index.entries()))
    assert all((index.find(_digest(i)) is not None) == (i in live) for i in range(4_000))
    assert not index.delete(_digest("none"))


def test_equal_fingerprints_are_told_apart():
    one, two = bytes(32), bytes(10) + b"x" * 22  # same place, same fingerprint
    index = CuckooIndex(2)
    index.insert([one, 1])
    assert index.find(two) is None
    index.insert([two, 2])
    assert index.find(two)[1] == 2 and index.delete(one) and index.find(two)[1] == 2


def test_overflow_resizes():
    index = CuckooIndex(2)
    for i in range(500):
        index.insert([_digest(i)])
    assert index.mask + 1 >= 128 and all(index.find(_digest(i)) for i in range(500))


def test_white_space_and_smallest_id(docs):
    found = exact_dedup(docs((5, "a  b"), (3, "a\tb"), (4, "a b "), (9, "a\n\nb"))).collect()
    verdict = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found}
    assert verdict == {5: (3, 3, False), 3: (3, 3, True), 9: (3, 3, False), 4: (4, 1, True)}
    assert {r.text_sha256 for r in found if r.doc_id == 3} == {hashlib.sha256(b"a b").hexdigest()}


def test_a_group_with_most_rows(docs):
    given = docs(*[(i, "copy" if i % 3 else f"own {i}") for i in range(3_000)]).repartition(13)
    found = exact_dedup(given).collect()
    assert Counter(r.kept for r in found) == {True: 1_001, False: 1_999}
    assert drop_copies(given).count() == 1_001


def test_index_takes_insertions_and_deletions(docs):
    keys = lambda *rows: docs(*rows).select("doc_id", digest_of().alias("digest"))
    index = build_index(keys((1, "a"), (2, "a"), (3, "b")))
    after = update_index(index, inserted=keys((0, "a"), (4, "c")), deleted=keys((3, "b"), (8, "never there"), (1, "a")))
    state = {(r.first_id, r.copies) for r in after.collect()}
    assert state == {(0, 2), (4, 1)}


def test_components_of_paths_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(500, 501), (501, 500)], "a long, b long")
    found = {r.node: r.comp for r in components(edges).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in range(100, 400)} == {100}
    assert found[501] == 500


def test_signatures_agree_as_often_as_sets_do():
    rng = random.Random(2)
    for shared, own in ((400, 100), (50, 0), (3, 1), (2_000, 2_000)):
        make = lambda tag, n: [f"{tag}{rng.random()}" for _ in range(n)]
        common = make("c", shared + 4)
        one = " ".join(common + make("a", own))
        two = " ".join(common + make("b", own))
        a, b = cells_of(shingles(one)), cells_of(shingles(two))
        exact = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        estimate = (signature(a, 2_000) == signature(b, 2_000)).mean()
        assert abs(estimate - exact) < 0.05


def test_weighted_signatures_count_repeats():
    a, b = shingles("a b c d e " * 40), shingles("a b c d e " * 20)
    agree = (signature(cells_of(a, True), 1_000) == signature(cells_of(b, True), 1_000)).mean()
    assert abs(agree - (20 * 5 - 4) / (40 * 5 - 4)) < 0.06
    assert (signature(cells_of(a), 500) == signature(cells_of(b), 500)).all()


def _brute(texts, least=0.8):
    sets = {}
    for key, text in texts.items():
        words = text.split()
        sets[key] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
    found = {key: key for key in texts}

    def root(x):
        while found[x] != x:
            x = found[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                found[max(x, y)] = min(x, y)
    return {key: root(key) for key in texts}


def test_classes_are_those_of_brute_force(docs):
    """Clusters whose members hardly reach the threshold with one another, and unrelated texts."""
    rng = random.Random(11)
    texts, key = {}, 0
    for cluster in range(6):
        base = [f"c{cluster}w{rng.randrange(10**6)}" for _ in range(300)]
        for _ in range(30):
            words = list(base)
            for _ in range(rng.choice([1, 3, 6, 7])):
                words[rng.randrange(300)] = f"x{rng.random()}"
            texts[key] = " ".join(words)
            key += 1
    for _ in range(60):
        texts[key] = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80)))
        key += 1
    texts[key], texts[key + 1] = "only four words here", "only  four words here"
    given = docs(*texts.items())
    found = {r.doc_id: r.class_id for r in near_dedup(given).collect()}
    assert found == _brute(texts)
    kept = {r.doc_id for r in drop_near_copies(given).collect()}
    assert kept == set(found.values())


def test_common_passages_are_no_near_copies(docs):
    passage = " ".join(f"p{i}" for i in range(60))
    given = docs(*[(i, passage + " " + " ".join(f"d{i}w{j}" for j in range(60))) for i in range(80)])
    assert {r.class_size for r in near_dedup(given).collect()} == {1}


def _changed(rng, base, at):
    words = list(base)
    for i in at:
        words[i] = f"x{rng.random()}"
    return " ".join(words)


def test_copies_that_link_only_to_their_original(docs):
    """Each copy has six words changed, far apart: 0.816 to the original, much less to one another. Every
    copy has to meet the original in large buckets."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    texts = [_changed(rng, base, [50 * k + rng.randrange(8, 42) for k in range(6)]) for _ in range(3_000)]
    given = docs((5_000, " ".join(base)), *enumerate(texts)).repartition(8)
    assert {r.class_size for r in near_dedup(given).collect()} == {3_001}


def test_links_between_blocks():
    """All components that links join, against brute force, within a block and between two."""
    rng = random.Random(6)
    texts = {}
    for cluster in range(8):
        base = [f"c{cluster}w{i}" for i in range(200)]
        for _ in range(12):
            texts[len(texts)] = _changed(rng, base, rng.sample(range(200), rng.choice([1, 3, 5, 6])))
    sets = [np.unique(shingles(text)) for text in texts.values()]
    expected = _brute(texts)
    found = {key: key for key in texts}
    for i, j in linked(sets, list(texts), 0, 0.8):
        low, high = sorted((found[i], found[j]))
        assert low != high
        found = {key: low if comp == high else comp for key, comp in found.items()}
    assert found == expected
    pairs = {(i, j) for i in range(40) for j in range(40, 96) if similarity(sets[i], sets[j]) >= 0.8}
    across = linked(sets, list(texts), 40, 0.8)
    assert across and set(across) <= pairs
    joined = dict(enumerate(texts))
    for i, j in across:
        joined = {key: joined[i] if comp == joined[j] else comp for key, comp in joined.items()}
    assert all(joined[i] == joined[j] for i, j in pairs)


def test_small_blocks_make_the_same_classes(docs):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    texts = {i: _changed(rng, base, rng.sample(range(300), rng.choice([4, 5, 6, 7]))) for i in range(90)}
    found = {r.doc_id: r.class_id for r in near_dedup(docs(*texts.items()), group=7).collect()}
    assert found == _brute(texts)
