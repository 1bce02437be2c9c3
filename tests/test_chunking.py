import random

import pytest
from pyspark.sql import functions as F

from docsheaf.functions.tokens import encoder_counter, estimated
from docsheaf.operators import chunking, numbering
from docsheaf.session import materialize, workspace

# sentence token counts of eight paragraphs
ARTICLE = [[9], [41, 31], [35, 22], [14, 30, 37], [26, 33, 29], [34, 49], [7, 34, 11, 30], [39]]


def words_for(tokens):
    return next(n for n in range(1000) if int(n * 1.33) == tokens)


def sentence(tokens, name):
    return " ".join([name] * words_for(tokens)) + "."


def article():
    return "\n\n".join(
        " ".join(sentence(t, f"p{p}s{s}") for s, t in enumerate(para, 1))
        for p, para in enumerate(ARTICLE, 1)
    )


def chunk_texts(spark, texts, limit, **kw):
    docs = spark.createDataFrame(
        [(i, "s", "file_txt", t) for i, t in enumerate(texts)],
        "doc_seq bigint, source string, source_type string, clean_text string",
    )
    rows = chunking.chunk_documents(docs, max_tokens=limit, **kw).collect()
    out = [[] for _ in texts]
    for r in sorted(rows, key=lambda r: (r.doc_seq, r.chunk_index)):
        assert r.chunk_index == len(out[r.doc_seq])
        out[r.doc_seq].append(r.text)
    for r in rows:
        assert r.total_chunks == len(out[r.doc_seq])
    return out


@pytest.mark.parametrize(
    "limit, firsts",
    [
        (800, ["p1s1"]),
        (250, ["p1s1", "p5s1", "p7s1"]),
        (200, ["p1s1", "p4s1", "p6s1", "p8s1"]),
        (100, ["p1s1", "p3s1", "p4s1", "p5s1", "p6s1", "p7s1", "p8s1"]),
        (60, ["p1s1", "p2s1", "p2s2", "p3s1", "p4s1", "p4s3", "p5s1", "p5s3", "p6s1", "p6s2",
              "p7s1", "p7s4", "p8s1"]),
    ],
)
def test_golden_packing(spark, limit, firsts):
    (chunks,) = chunk_texts(spark, [article()], limit)
    assert [c.split()[0].rstrip(".") for c in chunks] == firsts


def test_joiners_and_flushes(spark):
    long = "a b c d. e f g h! i j k l? m n o p."
    text = f"one two\n\nthree\n\n{long}\n\nfour\n\nfive six"
    (chunks,) = chunk_texts(spark, [text], 11)
    assert chunks == ["one two\n\nthree", "a b c d. e f g h!", "i j k l? m n o p.", "four\n\nfive six"]


def test_sentence_over_the_limit_stays_whole(spark):
    text = "Short one. " + "w " * 40 + "end. Last."
    (chunks,) = chunk_texts(spark, [text], 10)
    assert chunks == ["Short one.", ("w " * 40 + "end."), "Last."]


def test_limit_bounds_the_sum_of_counts(spark):
    # each one-word paragraph counts 1, the joined text counts more
    (chunks,) = chunk_texts(spark, ["\n\n".join(["w"] * 10)], 10)
    assert len(chunks) == 1


def test_blank_documents_leave_no_chunk(spark):
    assert chunk_texts(spark, ["", " \n\n \n", "x"], 10) == [[], [], ["x"]]
    docs = spark.createDataFrame([("a", ""), ("b", "x")], "source string, clean_text string")
    rejects = chunking.without_chunks(chunking.add_chunks(docs))
    assert [tuple(r) for r in rejects.collect()] == [("a", "preprocess", "no usable text")]


def test_packing_properties(spark):
    """Order, bound and greed together fix the result of packing."""
    rng = random.Random(7)
    docs = []
    for _ in range(60):
        paras = [
            " ".join(
                " ".join(rng.choices("ab", k=rng.randint(1, 12))) + rng.choice(".!?")
                for _ in range(rng.randint(1, 6))
            )
            for _ in range(rng.randint(1, 8))
        ]
        docs.append("\n\n".join(paras))
    limit = 20
    count = lambda t: int(len(t.split()) * 1.33)
    packed = chunk_texts(spark, docs, limit)
    # the one-pass count and the general path for any counter agree
    assert packed == chunk_texts(spark, docs, limit, counter=lambda ts: estimated(ts))
    for text, chunks in zip(docs, packed):
        assert " ".join(chunks).split() == text.split()
        paras = text.split("\n\n")
        long = {p for p in paras if count(p) > limit}
        for chunk, following in zip(chunks, chunks[1:] + [None]):
            units = chunk.split("\n\n")
            if units[0] not in paras:
                units = [s.replace("\0", "") for s in
                         chunk.replace(". ", ".\0\n").replace("! ", "!\0\n").replace("? ", "?\0\n").split("\n")]
            assert len(units) == 1 or sum(map(count, units)) <= limit
            if following and units[0] in paras and following.split("\n\n")[0] in paras:
                nxt = following.split("\n\n")[0]
                assert nxt in long or units[0] in long or sum(map(count, units)) + count(nxt) > limit


def test_python_counter(spark):
    letters = encoder_counter(lambda: lambda t: [c for c in t if c.isalpha()])
    text = "aaa\n\nbb\n\ncccc\n\ndddd eeee. ffff. gg."
    (chunks,) = chunk_texts(spark, [text], 8, counter=letters)
    assert chunks == ["aaa\n\nbb", "cccc", "dddd eeee.", "ffff. gg."]


def test_doc_stats(spark):
    docs = spark.createDataFrame([(1, "s", "  a b  ", "a b")], "doc_seq bigint, source string, raw_text string, clean_text string")
    row = chunking.doc_stats(chunking.add_chunks(docs)).first()
    assert (row.chars_raw, row.chars_clean, row.tokens, row.total_chunks) == (7, 3, 2, 1)


def test_preview_counts_characters(texts):
    text = "x" * 199 + "\U0001f600" + "y"
    assert texts(chunking.preview, [text]) == ["x" * 199 + "\U0001f600"]


def test_numbers_are_dense_over_sparse_documents(spark):
    rng = random.Random(3)
    keys = sorted({rng.randrange(2**62) for _ in range(200)} | set(range(50)) | {2**21 - 1, 2**21, 2**42, 2**63 - 1})
    rows = [(k, i, n) for k in keys for n in [rng.randint(1, 4)] for i in range(n)]
    rng.shuffle(rows)
    chunks = spark.createDataFrame(rows, "doc_seq bigint, chunk_index int, total_chunks int")
    chunks = materialize(chunks, workspace(spark, "chunks"))
    numbered = numbering.number_chunks(chunks, numbering.chunk_offsets(chunks)).collect()
    ordered = sorted(numbered, key=lambda r: (r.doc_seq, r.chunk_index))
    assert [r.chunk_id for r in ordered] == list(range(1, len(rows) + 1))


def test_numbers_of_a_subset_have_gaps(spark):
    chunks = spark.createDataFrame([(5, 0, 2), (5, 1, 2), (9, 0, 1)], "doc_seq bigint, chunk_index int, total_chunks int")
    offsets = numbering.chunk_offsets(chunks)
    some = chunks.filter(F.col("chunk_index") == 0)
    assert sorted(r.chunk_id for r in numbering.number_chunks(some, offsets).collect()) == [1, 3]


def test_packing_is_planned_once(spark):
    """No filter on the chunk array is pushed below the packing, and no row carries the array."""
    docs = spark.createDataFrame([(1, "s", "t", "x")], "doc_seq bigint, source string, source_type string, clean_text string")
    plan = chunking.chunk_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    # one fold over the words of a paragraph, one over blocks of units, one over the units of a block
    assert plan.count("aggregate(") == 3
