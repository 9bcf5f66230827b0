from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from newsloom.llm.token_counts import Counts, prove_whole_tokens, token_counts, whole_tokens
from newsloom.llm.vocabulary import Encoder

ENCODERS = {name: Encoder(public_tokenizers.path(name), memo=500) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}
PLAIN = st.text(st.sampled_from(sorted(map(chr, [*range(0x20, 0x7F), 9, 10, 11, 12, 13, *range(0xC0, 0x180)]))), max_size=60)
SPACED = st.lists(st.sampled_from(["the", "'s", "'S", "Don't", "été", "İ", "12", " ", "  ", "\n", "\n\n ", "!?", "|", "'", "<|endoftext|>", "中", "é", " "]), max_size=25).map("".join)


@pytest.mark.parametrize("name", ENCODERS)
def test_ids_are_the_librarys(name):
    codec = ENCODERS[name]

    @settings(max_examples=600, deadline=None)
    @given(st.one_of(PLAIN, SPACED, st.text(max_size=30)))
    def check(text):
        assert codec.ids(text) == array("I", codec.library(text)).tobytes()

    check()


def test_every_plain_character():
    for codec in ENCODERS.values():
        for code in range(0x250):
            for text in (chr(code), f"a{chr(code)}b", f" {chr(code)} "):
                assert codec.ids(text) == array("I", codec.library(text)).tobytes(), hex(code)


def test_proven_strings_are_one_token():
    codec = ENCODERS["word_bpe_49k.json"]
    proven = prove_whole_tokens(codec)
    assert len(proven) > 10_000
    assert all(len(codec.library(text)) == 1 for text in proven[::97])


def test_strings_are_proven_once_in_a_job(spark, odd):
    codec = ENCODERS["word_bpe_49k.json"]
    table = whole_tokens(spark, codec.path)
    strings = [row.token for row in table.collect()]
    assert len(strings) == len(set(strings)) and set(strings) == set(prove_whole_tokens(codec))
    expected = sorted((row.doc_id or 0, len(codec.library(row.text or ""))) for row in odd.select("doc_id", "text").collect())
    for whole in (None, table, table.limit(0)):
        counted = token_counts(odd, codec.path, whole=whole)
        assert sorted((row.doc_id or 0, row.n_tokens) for row in counted.collect()) == expected


def test_counts():
    table = Counts(ENCODERS["word_bpe_49k.json"])

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(PLAIN, SPACED))
    def check(text):
        assert table.of(text) == len(table.codec.library(text))

    check()


def test_unknown_kinds_go_to_the_library_whole(tmp_path):
    import json

    config = json.load(open(public_tokenizers.path("byte_bpe_50k.json")))
    config["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(config))
    codec = Encoder(str(path))
    assert codec.pieces("plain text") is None
    assert codec.ids("plain text") == array("I", codec.library("plain text")).tobytes()
