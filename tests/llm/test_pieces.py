import random

import pytest

from docsheaf.llm import pieces
from docsheaf.llm.queries import tokenizer_file

sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rnd = random.Random(1)
    letters = "ab cde  \n\té日本語😀1234567890'\".,()=<>/\\_-AaBb\x00ſ"
    out = ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(1500)]
    return [*out, "aaaaaaaaaaaaaaaaaaaaa", "   x", "x   ", "    ", "<s> </s> <0x0A> <unk>", "\x00\x00a\x00", "é"]


@pytest.mark.parametrize("short", [0, 5, 48])
def test_equal_to_the_library(model, short, monkeypatch):
    """Rounds for short stretches and relaxing for long ones give the same pieces."""
    monkeypatch.setattr(pieces, "SHORT", short)
    encoder, decoder, own = pieces.Encoder(PATH), pieces.Decoder(PATH), texts()
    import numpy as np

    for text, ids in zip(own, encoder(own), strict=True):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == model.encode(text), text
        assert decoder(ids) == model.decode(ids)


def test_a_very_long_stretch(model):
    import numpy as np

    rnd = random.Random(3)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    assert np.frombuffer(pieces.Encoder(PATH)([text])[0], "<i4").tolist() == model.encode(text)


def test_documents(spark, model, odd, odd_extra, empty):
    rows = pieces.encode_and_decode(odd, PATH).collect()
    expected = sorted((str(r.doc_id), model.encode(r.text or "")) for r in odd.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == expected
    assert all(r.decoded_equal and r.n_pieces == len(r.ids) for r in rows)
    assert pieces.encode_and_decode(odd_extra, PATH).count() == 9
    assert pieces.encode_and_decode(empty, PATH).collect() == []
    back = pieces.decode(pieces.encode(odd.filter("doc_id = 1"), PATH), PATH).collect()
    assert back[0].text == odd.filter("doc_id = 1").first().text
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert pieces.decode(nothing, PATH).first().text == ""
