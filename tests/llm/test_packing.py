import public_tokenizers
from tokenizers import Tokenizer

import numpy as np

from newsloom.llm.packing import balance, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _check(docs, size, **how):
    whole = Tokenizer.from_file(PATH)
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    pieces = pack(docs, PATH, size=size, **how).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(given)
    for key, parts in by_doc.items():
        ids = whole.encode(given[key], add_special_tokens=False).ids + [1]
        parts.sort(key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == ids
        assert {p.doc_tokens for p in parts} == {len(ids)}
    used = []
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in parts])
        assert [p.offset for p in parts] == [0, *ends[:-1].tolist()]
        used.append(int(ends[-1]))
    return used


def test_whole_tables(docs):
    texts = [(i, " ".join(f"w{i}x{j}" for j in range((i * 37) % 300))) for i in range(120)] + [(999, None), (1000, "")]
    used = _check(docs(*texts).coalesce(2), 256, buffer_tokens=4096)
    assert max(used) == 256
    assert all(n & (n - 1) == 0 for n in used)  # full, or a power of two: no padding


def test_one_short_document(docs):
    assert sum(_check(docs((1, "a few words")), 2048)) > 0


def test_dear_pieces_go_first_to_the_cheapest_sequence():
    placed, left = balance([10, 60, 50, 30], 2, 100, 1.0, 0.1)
    where = {piece: sequence for piece, _, _, sequence, _ in placed}
    assert where[1] != where[2] and where[3] == where[2] and left == []


def test_what_fits_nowhere_is_cut_and_nothing_is_lost():
    lengths = [70, 70, 70, 30]
    placed, left = balance(lengths, 2, 100, 1.0, 0.1)
    assert sum(n for _, _, n, _, _ in placed) == 200
    assert sum(n for _, _, n in left) == sum(lengths) - 200
    room = np.zeros(2, int)
    for _, _, n, sequence, offset in sorted(placed, key=lambda p: (p[3], p[4])):
        assert offset == room[sequence]
        room[sequence] += n
    assert room.tolist() == [100, 100]
