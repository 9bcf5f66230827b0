"""Alignment against a plain one: whole texts through both libraries, all pairs of tokens compared."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from newsloom.llm import queries as llm
from newsloom.llm.alignment import NOTHING, Aligner, align

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
FIRST = Tokenizer.from_file(BYTES)
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def byte_level(token: str) -> bytes:
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return bytes(ord(c) if ord(c) < 256 and ord(c) in plain else rest[ord(c) - 256] for c in token)


def piece_bytes(i: int) -> bytes:
    piece = SECOND.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if SECOND.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(id, start, end) of both tokenizers, or nothing."""
    if not text:
        return [], []
    out = []
    for ids, spell in (
        (FIRST.encode(f" {text}", add_special_tokens=False).ids, lambda i: byte_level(FIRST.id_to_token(i))),
        (SECOND.encode(text), piece_bytes),
    ):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(spell(i))))
            at = spans[-1][2]
        if b"".join(spell(i) for i in ids) != f" {text}".encode():
            return [], []
        out.append(spans)
    return tuple(out)


def plain(text):
    a, b = tokens(text)
    shared = sorted({t[2] for t in a} & {t[2] for t in b})
    groups, before = [], 0
    for end in shared:
        groups.append("|".join(",".join(str(i) for i, s, e in side if before <= s < end) for side in (a, b)))
        before = end
    links = [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]
    return len(a), len(b), len(groups), len(links), ";".join(groups), sorted(x << 32 | y for x, y in links)


PARTS = st.sampled_from([
    "the", "été", " ", "  ", "\n", "\t", "Ångström", "中文字", "é́", "▁", "🙂", "👨‍👩‍👧", "<|endoftext|>", "<s>", "<0x41>",
    "\x00", "\x1c", "\x85", " ", "Ⅳ", "ｱ", "İ", "don't", "'S", "word,", "123", "a_b", "…", "߿", "ࠀ", "\U00010348",
])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=20).map("".join), st.lists(PARTS, max_size=12).map(" ".join), st.text(max_size=40)))
def test_any_text(text):
    tool = test_any_text.__dict__.setdefault("tool", Aligner(BYTES, PIECES, memo=200))
    (found,) = tool.texts([text])
    assert (*found[:5], sorted(np.frombuffer(found[5], np.int64).tolist())) == plain(text)


def test_a_text_that_does_not_come_back_takes_no_other_with_it():
    tool = Aligner(BYTES, PIECES)
    whole = tool.texts(["one ▁ two", "one two", "x▁ y", ""])
    assert whole[0] == NOTHING and whole[2] == NOTHING and whole[3] == NOTHING
    assert whole[1][:4] == plain("one two")[:4]


def test_chunks_that_come_again_stay_remembered(monkeypatch):
    """Room is made by forgetting chunks that came once, not those that came late."""
    tool = Aligner(BYTES, PIECES, memo=40)
    learned, learn = [], tool.learn
    monkeypatch.setattr(tool, "learn", lambda chunks: (learned.extend(chunks), learn(chunks))[1])
    texts = [" ".join(f"first{j}" for j in range(30))]
    texts += ["again late often " + " ".join(f"once{i}x{j}" for j in range(3)) for i in range(60)]
    for text in texts:
        (found,) = tool.texts([text])
        assert (*found[:5], sorted(np.frombuffer(found[5], np.int64).tolist())) == plain(text)
    assert max(Counter(learned).values()) == 1 and len(tool) <= 40


def table(rows):
    """Plain results for (doc_id, text) rows."""
    made = [plain(text) for _, text in rows]
    counts = Counter(pair for one in made for pair in set(one[5]))
    most = Counter()
    for pair, n in counts.items():
        most[pair >> 32] = max(most[pair >> 32], n)
    out = []
    for (doc_id, _), (n_a, n_b, n_groups, n_links, groups, pairs) in zip(rows, made):
        best = sum(counts[p] == most[p >> 32] for p in pairs)
        out.append((doc_id, n_a, n_b, n_groups, n_links, best, sum(counts[p] for p in pairs), groups))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_chars", [1, 5_000, 8 << 20])
def test_counts_of_pairs(spark, odd, block_chars):
    """Nulls, empty and long texts, repeated rows; any size of blocks gives the same."""
    rows = [(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id != 7").collect()]
    found = align(odd.where("doc_id is null or doc_id != 7").repartition(3), BYTES, PIECES, block_chars=block_chars)
    assert sorted(map(tuple, found.collect()), key=repr) == table(rows)


def test_long_text_and_empty_table(odd, empty):
    (row,) = align(odd.where("doc_id = 7"), BYTES, PIECES).collect()
    text = odd.where("doc_id = 7").first().text
    assert row.n_a == len(FIRST.encode(f" {text}", add_special_tokens=False).ids) and row.n_b == len(SECOND.encode(text))
    assert align(empty, BYTES, PIECES).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in llm.documents(spark, sf).collect() if len(r.text) < 900]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = align(docs, BYTES, PIECES).collect()
    assert sorted(map(tuple, found), key=repr) == table(rows)
    digests = {r.doc_id: r.groups_sha256 for r in llm.queries()["op11_alignment"](spark, sf).collect()}
    assert len(digests) == 200
    for doc_id, groups in [(r.doc_id, r.groups) for r in found]:
        assert digests[doc_id] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
