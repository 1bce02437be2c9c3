import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docsheaf.llm import token_store as ts
from docsheaf.llm.queries import tokenizer_file

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_file("word_bpe_49k.json")


def brute(rows):
    tokenizer, start, out = tokenizers.Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def result(df):
    rows = ts.store_digest(df, PATH).collect()
    return sorted([tuple(r) for r in rows], key=lambda r: r[1])


def test_texts_of_all_kinds(table):
    rnd = random.Random(2)
    letters = "aZ '’.,!\n\té日😀\x00\x01 ΣſK1½<|endoftext|>"
    rows = [(k, "".join(rnd.choices(letters, k=rnd.randint(0, 40)))) for k in range(400)]
    rows += [(500, "a<|endoftext|>b"), (501, "it's don't we'll IT'S"), (502, "é ́x"), (503, "ΟΔΟΣ ΣΑΣ")]
    assert result(table(rows)) == brute(rows)


def test_odd_rows(odd, odd_extra, empty):
    assert result(odd) == brute([tuple(r) for r in odd.collect()])
    assert len(result(odd_extra)) == 9
    assert result(empty) == []


@pytest.mark.parametrize("longest", [8, 10, 20])
def test_code_lengths(longest):
    rnd = np.random.default_rng(1)
    counts = (2.0 ** rnd.uniform(0, 30, 200)).astype(np.int64) + 1
    lengths = ts.code_lengths(counts, longest)
    assert lengths.max() <= longest and (0.5**lengths).sum() <= 1
    if longest == 20:
        import heapq

        # the cost of a code without a limit that binds is that of Huffman's
        heap = sorted(counts.tolist())
        cost = 0
        while len(heap) > 1:
            pair = heapq.heappop(heap) + heapq.heappop(heap)
            cost += pair
            heapq.heappush(heap, pair)
        assert (lengths * counts).sum() >= cost
        assert (lengths * counts).sum() <= cost * 1.001


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_pack_and_unpack(n):
    rnd = np.random.default_rng(n)
    known = np.array([3, 7, 8, 500, 40_000])
    code = ts.Code(known, ts.code_lengths(np.array([900, 1, 5, 70, 2])))
    ids = rnd.choice(known, n)
    payload, bits = code.pack(ids)
    assert ts.Code.unpack(payload, bits, n, code.width, code.table()).tolist() == ids.tolist()


def test_one_symbol():
    code = ts.Code(np.array([2]), ts.code_lengths(np.array([10])))
    payload, bits = code.pack(np.full(70, 2))
    assert ts.Code.unpack(payload, bits, 70, code.width, code.table()).tolist() == [2] * 70


def test_frequent_pieces_are_made_once(monkeypatch):
    monkeypatch.setattr(ts, "REMEMBERED", 8)
    tokens, made = ts.WordTokens(PATH), []
    piece = tokens.piece
    tokens.piece = lambda text: made.append(text) or piece(text)
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    for k in range(12):
        text = "often " + " ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(12))
        ids, bounds = tokens(pa.array([text, "", text]))
        own = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert ids.tolist() == [*own, 2, *own] and bounds.tolist() == [0, len(own), len(own) + 1, 2 * len(own) + 1]
    assert made.count("often") == 1


def test_words_without_pieces_in_common():
    tokens, words = ts.WordTokens(PATH), ["it's", "ĂB12c", "''s", "Éà.ß", "日本", "a\x01", "ª", "x÷y", "don't'll", "ŉ", "É"]
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    found = tokens.words(pa.array(words)).to_pylist()
    assert [np.frombuffer(ids, tokens.kind).tolist() for ids in found] == [
        tokenizer.encode(word, add_special_tokens=False).ids for word in words
    ]
