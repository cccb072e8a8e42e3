import hashlib
import random
import struct

import numpy as np
import pytest

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from chronolink.llm import queries, sentence_pieces  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a ", "\n", "\n a", "a\n\n\nb", "▁", "▁ ▁a", "\t\tx", "日本語 テスト", "😀😀 a", "<s>", "</s> a <unk>", "<0x0A>",
       "é é", "x" * 300, " " * 100, "a" + " " * 50 + "b", "　 x y\u0085z", "\0a \0", "�", "f(x). \"(a).\" 3.14, it's", "ab" * 999, "Ⅷ ﬁ ½", "word " * 500]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.read_model(tokenizers.path("piece_bpe_32k.model"))


def random_texts(n, seed=1):
    rng, alphabet = random.Random(seed), "abcdeéñ日本😀 \n\t.,▁1234567890thereinandof  "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(n)]


def same(coder, library, texts):
    for text, (ids, begins, ends) in zip(texts, coder.encode(texts)):
        proto = library.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in proto.pieces], text
        assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in proto.pieces], text
        assert coder.decode(np.append(ids, 2)).decode() == library.decode([*ids.tolist(), 2])


def test_ids_spans_and_text_are_the_librarys(model, library):
    same(sentence_pieces.Coder(model), library, ODD + random_texts(800))


def test_long_words_and_whole_texts(model, library, monkeypatch):
    """Words by heap, and texts that are not cut into words, come to the same."""
    monkeypatch.setattr(sentence_pieces, "SHORT", 1)
    monkeypatch.setattr(sentence_pieces, "KNOWN_WORDS", 50)
    coder = sentence_pieces.Coder(model)
    for k in range(0, 300, 100):
        same(coder, library, ODD + random_texts(100, k))
    coder.cut = None
    same(coder, library, ODD + random_texts(50))


def test_spans_cover_the_text(model):
    for text in ODD[1:]:
        (_, begins, ends), = sentence_pieces.Coder(model).encode([text])
        data = text.encode()
        assert b"".join(data[b:e] for b, e in zip(begins, ends)) == data


def test_ids_that_no_text_has(model, library):
    """Continuation bytes without their lead, control ids, the unknown id."""
    rng, coder = random.Random(2), sentence_pieces.Coder(model)
    for _ in range(300):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randint(0, 8))]
        if all(i < 3 or i >= 259 or i - 3 < 128 for i in ids):
            assert coder.decode(np.array(ids, np.int32)).decode() == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
def test_compiled_map_normalises_as_the_library(rule):
    """The library's own maps, with spaces squeezed: texts and the source of each character."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    spec = proto.normalizer_spec
    model = sentence_pieces.Model(["<unk>"], [2], [0.0], spec.precompiled_charsmap, spec.add_dummy_prefix, True, spec.escape_whitespaces)
    coder = sentence_pieces.Coder(model)
    alphabet = "aAéÉ́ｶﾞﾊﾟ①½ﬁ 　\t​日ΑΣςͅ "
    rng = random.Random(3)
    for text in ["", "  ", "ｶﾞ ﬁ  ① ", "é x", *("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(400))]:
        got, back = coder.normalize(text)
        assert got == library.normalize(text), text
        assert len(back) == len(got.encode()) + 1 and (np.diff(back) >= 0).all()
        if got:
            assert back[0] >= 0 and back[-1] <= len(text.encode())


def test_alignment_through_the_map():
    """Full-width letters, a ligature and a composed accent point back to the bytes they came from."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto())
    model = sentence_pieces.Model(["<unk>"], [2], [0.0], proto.normalizer_spec.precompiled_charsmap, False, False, False)
    text = "ＡﬁXéY"
    got, back = sentence_pieces.Coder(model).normalize(text)
    assert got == "AfiXéY" and back.tolist() == [0, 3, 3, 6, 7, 7, 10, 11]


def test_without_byte_fallback():
    """A run of characters that are no pieces is one unknown piece, over words too."""
    pieces = ["<unk>", "<s>", "</s>", "▁a", "b", "▁", "a"]
    model = sentence_pieces.Model(pieces, [2, 3, 3, 1, 1, 1, 1], [0, 0, 0, -1, -2, -3, -4], byte_fallback=False)
    (ids, begins, ends), = sentence_pieces.Coder(model).encode(["a日本b é!b"])
    assert ids.tolist() == [3, 0, 4, 5, 0, 4]
    assert list(zip(begins.tolist(), ends.tolist())) == [(0, 1), (1, 7), (7, 8), (8, 9), (9, 12), (12, 13)]


def test_other_models_are_refused(model, tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        sentence_pieces.read_model(str(path))


def told(library, text):
    ids = library.encode(text or "", return_type="proto").pieces
    listed = [*(p.id for p in ids), 2]
    spans = struct.pack(f"<{len(ids)}q", *(p.begin for p in ids)) + struct.pack(f"<{len(ids)}q", *(p.end for p in ids))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    import zlib

    return len(listed), sha(" ".join(map(str, listed))), sha(library.decode(listed)), zlib.crc32(spans)


def test_query_against_the_library(spark, library):
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted((r.doc_id, *told(library, r.text)) for r in texts)
    assert sorted(map(tuple, queries.queries()["op11_sentencepiece"](spark, SF).collect())) == want


def test_messy(messy, documents, model, library):
    got = sentence_pieces.encode_decode(messy, model, with_spans=True).collect()
    texts = [(r.doc_id, r.text) for r in messy.collect()]
    key = lambda r: str(tuple(r))
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted([(i, *told(library, t)) for i, t in texts], key=key)
    assert all(r.ids[-1] == 2 and len(r.begins) == len(r.ends) == r.n_tokens - 1 for r in got)
    assert sentence_pieces.encode_decode(documents([]), model).collect() == []
