import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from newsloom.llm import token_files
from newsloom.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_blocks_come_back(ranks):
    block = token_files.encode_block(np.array(ranks, dtype="<u4"))
    n, size = np.frombuffer(block[:8], "<u4").tolist()
    control = np.frombuffer(block[8:8 + (n + 3) // 4], np.uint8)
    data = np.frombuffer(block[8 + (n + 3) // 4:], np.uint8)
    assert len(data) == size and token_files.decode_block(n, control, data).tolist() == ranks


def test_file_of_several_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    rng = np.random.default_rng(3)
    documents = [(i if i % 7 else None, rng.integers(0, 70_000, n).astype("u4")) for i, n in enumerate([0, 1, 200, 63, 64, 65, 500, 3])]
    ranks = rng.permutation(70_000).astype("u4")
    id_at = np.argsort(ranks).astype("u4")
    path = str(tmp_path / "one.tok")
    assert token_files.write_file(path, iter(documents), ranks) == (8, 896)
    back = list(token_files.read_file(path, id_at))
    assert [k for k, _ in back] == [k for k, _ in documents]
    assert all(a.tolist() == b.tolist() for (_, a), (_, b) in zip(back, documents))


def test_round_trip_in_id_order(spark, docs):
    texts = {i: " ".join(["the", f"cat{i}"] * (i % 13)) for i in range(200)}
    whole = Tokenizer.from_file(PATH)
    path = scratch_dir(spark, "token-files")
    token_files.write_token_files(docs(*[(i, texts[i]) for i in reversed(texts)]).repartition(5), path, PATH, files=4)
    found = sorted(token_files.read_token_files(spark, path).collect())
    start = 0
    for row in found:
        ids = whole.encode(texts[row.doc_id], add_special_tokens=False).ids + [2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)
    assert [r.doc_id for r in found] == list(texts)
    ranks = np.frombuffer(open(f"{path.removeprefix('file://')}/ranks.bin", "rb").read(), "<u4")
    assert ranks[0] in (2, whole.token_to_id("the</w>"))  # the most frequent
