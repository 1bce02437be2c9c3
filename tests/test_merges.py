import random

import pytest
from pyspark.sql import functions as F

from docsheaf.functions.merges import Merger, PieceCounter, merge_counter, read_ranks
from docsheaf.operators.chunking import chunk_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def brute(piece, ranks):
    """Merge the least pair, the first of equals, until there is none."""
    parts = [bytes([b]) for b in piece]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not found:
            return len(parts)
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_merges_against_brute_force():
    rnd = random.Random(1)
    for _ in range(20):
        tokens = {bytes([b]) for b in range(256)}
        for _ in range(30):
            a, b = rnd.choices(sorted(t for t in tokens if set(t) <= set(b"abc")), k=2)
            tokens.add(a + b)
        order = sorted(tokens, key=lambda t: (len(t) > 1, rnd.random()))
        ranks = {t: k for k, t in enumerate(order)}
        pieces = [bytes(rnd.choices(b"abcd", k=rnd.randint(1, 12))) for _ in range(100)]
        assert Merger(ranks).counts(pieces).tolist() == [brute(p, ranks) for p in pieces]
    assert Merger(ranks).counts([]).tolist() == []


def test_all_documents(spark, encoding):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    counter = merge_counter(lambda: read_ranks(PATH), PATTERN)
    found = docs.select("doc_id", F.get(counter(F.array("text")), F.lit(0)).alias("n")).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.n for r in found} == {doc: len(encoding.encode_ordinary(t)) for doc, t in texts.items()}


def test_odd_texts(encoding):
    rnd = random.Random(2)
    letters = "aZ '’.,!\n\té日😀\x00 ΣſK1½<|endoftext|>  "
    texts = ["", " ", "x" * 5000, "ab " * 3000, *["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(300)]]
    counter = PieceCounter(read_ranks(PATH), PATTERN)
    for _ in range(2):
        assert counter(texts) == [len(encoding.encode_ordinary(t)) for t in texts]


def test_chunks_are_bounded_by_merged_tokens(spark, encoding):
    rows = [(k, "s", "file_txt", f"One sentence here, number {k}. " * (k % 9 + 1) + "\n\nAnother paragraph.") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_seq bigint, source string, source_type string, clean_text string")
    counter = merge_counter(lambda: read_ranks(PATH), PATTERN)
    for r in chunk_documents(docs, max_tokens=20, counter=counter).collect():
        assert len(encoding.encode_ordinary(r.text)) <= 20 + 2
