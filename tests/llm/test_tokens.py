import hashlib
import itertools
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("public_tokenizers")

from chronolink.llm import bpe, packing  # noqa: E402
from chronolink.llm.queries import gpt_encoder  # noqa: E402

ODD = ["", "<|endoftext|>", "a <|endoftext|> b", " \n\n  x 　 y\u0085z", "'s 'S 're", "日本語 テスト ١٢٣ ²½", "​﻿ é 😀" * 3, "x" * 3000, "aaaaaaa", "ab" * 999]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")


@pytest.fixture(scope="module")
def tiktoken_ids():
    import tiktoken

    ranks = bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    e = tiktoken.Encoding("x", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, lambda text: np.array(e.encode_ordinary(text or ""), "<u4")


def test_hilbert_visits_neighbours():
    at = {packing.hilbert(list(c), 2): c for c in itertools.product(range(4), repeat=4)}
    assert sorted(at) == list(range(256))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(255))


def test_encoder_is_the_library(library):
    encode = gpt_encoder()
    for text in ODD:
        assert encode(text).tolist() == library(text).tolist()


@pytest.mark.parametrize("shard_ids", [8 << 20, 3000])
def test_packing_round_trip(documents, messy, library, monkeypatch, shard_ids):
    monkeypatch.setattr(packing, "SHARD_IDS", shard_ids)
    rows = [(100 + i, t) for i, t in enumerate(ODD * 3)]
    found = packing.pack(documents(rows), gpt_encoder, with_ids=True).toPandas()
    want = {i: np.append(library(t), np.uint32(1)) for i, t in rows}
    for i, g in found.groupby("doc_id"):
        g = g.sort_values("start")
        assert np.concatenate(g.ids.tolist()).tolist() == want[i].tolist() and (g.doc_tokens == len(want[i])).all()
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]]
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in g.ids] == g.ids_crc32.tolist()
    assert set(found.doc_id) == set(want)
    sizes = found.groupby("sequence_id").length.sum()
    assert (sizes < 2048).sum() <= 1 and sizes.max() <= 2048
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    assert packing.pack(messy, gpt_encoder).filter("start = 0").count() == messy.count()
    assert packing.pack(documents([]), gpt_encoder).collect() == []


def test_copies_lie_together(documents):
    rows = [(i, ("same words in every copy " * 40) if i % 2 else f"text {i} " * 90) for i in range(40)]
    found = packing.pack(documents(rows), gpt_encoder, length=64).toPandas()
    order = found.sort_values(["sequence_id", "offset"]).drop_duplicates("doc_id").doc_id.tolist()
    copies = [k for k, i in enumerate(order) if i % 2]
    assert copies[-1] - copies[0] == len(copies) - 1


def test_bpe_against_the_library(documents, tiktoken_ids):
    ranks, ids = tiktoken_ids
    rows = list(enumerate([*ODD, None]))
    found = {r.doc_id: r for r in bpe.encode_decode(documents(rows), ranks, tokenizers.PATTERN, with_ids=True).collect()}
    for i, text in rows:
        want = ids(text)
        assert found[i].ids == want.tolist() and found[i].n_tokens == len(want)
        assert found[i].ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() and bytes(found[i].decoded) == (text or "").encode()


def test_bpe_in_few_rows(tiktoken_ids, monkeypatch):
    """With little room the recursion is resumed where it stopped."""
    ranks, ids = tiktoken_ids
    monkeypatch.setattr(bpe, "HELD_ROWS", 4000)
    monkeypatch.setattr(bpe, "SHORT", 16)
    v = bpe.Vocabulary(ranks)
    coder = bpe.Coder(v.ids, v.pairs, v.bytes, tokenizers.PATTERN)
    assert [c.tolist() for c in coder.encode(ODD)] == [ids(t).tolist() for t in ODD]


def test_bpe_messy(messy, documents, tiktoken_ids):
    ranks, _ = tiktoken_ids
    assert bpe.encode_decode(messy, ranks, tokenizers.PATTERN).count() == messy.count()
    assert bpe.encode_decode(documents([]), ranks, tokenizers.PATTERN).collect() == []
