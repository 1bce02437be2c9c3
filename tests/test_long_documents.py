import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docsheaf.operators import long_documents as L
from docsheaf.operators.chunking import chunk_documents
from docsheaf.operators.cleaning import clean_documents
from docsheaf.plans.inputs import document_pieces
from docsheaf.session import materialize


def folded(units, most):
    """The rule as a fold: the number of each unit's chunk."""
    out, chunk, total, before = [], 0, 0, None
    for doc, para, long, tokens in units:
        new = before is None or before[0] != doc or (long and before[1] != para) or (not long and before[2])
        if new or total + tokens > most:
            chunk, total = chunk + 1, 0
        total += tokens
        out.append(chunk)
        before = (doc, para, long)
    return out


def random_units(rnd, n, most):
    """Paragraphs in documents; sometimes one long paragraph without end, or counts that never come together."""
    kind, units, doc, para = rnd.random(), [], 0, 0
    while len(units) < n:
        if kind < 0.3:
            units.append((0, 0, True, rnd.choice([1, 1, most // 3, 0])))
        elif kind < 0.5:
            units.append((0, len(units), False, 1))
        else:
            doc, para = doc + (rnd.random() < 0.02), para + 1
            if rnd.random() < 0.1:
                units += [(doc, para, True, rnd.randint(0, 2 * most)) for _ in range(rnd.randint(1, 40))]
            else:
                units.append((doc, para, False, rnd.randint(0, most)))
    return units[:n]


def table(spark, units):
    rows = [(n, *u) for n, u in enumerate(units)]
    return spark.createDataFrame(rows, "n bigint, doc_seq bigint, para bigint, long boolean, tokens bigint")


@pytest.mark.parametrize("seed", range(12))
def test_blocks_map_sums_as_the_fold_does(seed):
    rnd = random.Random(seed)
    for _ in range(30):
        most = rnd.choice([1, 7, 60])
        units = random_units(rnd, rnd.randint(1, 60), most)
        rows = pd.DataFrame(units, columns=["doc_seq", "para", "long", "tokens"])
        rows["n"], rows["lead"] = np.arange(len(rows)), False
        rows.loc[0, "lead"] = True
        block = L.Block(rows, most)
        if not block.n:
            continue
        first, total, prefix, leaves, fixed = block.map()
        row = type("row", (), {"first": first, "total": total, "prefix": prefix, "leaves": leaves, "none_opens": first >= block.n})
        for left in range(2 * most + 2):
            now, opened = left, []
            for k, (forced, tokens) in enumerate(zip(block.forced, block.rows["tokens"], strict=True)):
                if forced or now + tokens > most:
                    now = 0
                    opened.append(k)
                now += tokens
            assert np.flatnonzero(np.diff(block.opened(left), prepend=0)).tolist() == opened
            assert L.applied(row, left, most) == now and fixed in (None, now)


@pytest.mark.parametrize("seed", range(4))
def test_packing_equals_the_fold(spark, monkeypatch, seed):
    monkeypatch.setattr(L, "BLOCK", 16)
    monkeypatch.setattr(L, "BLOCKS_PER_ROW", 3)
    rnd = random.Random(seed)
    units = random_units(rnd, rnd.choice([1, 16, 320, 500]), 20)
    found = L.packed_units(table(spark, units), 20).orderBy("n").collect()
    assert [r.chunk for r in found] == folded(units, 20)


def cut(rnd, text):
    out, at = [], 0
    while at < len(text) or not out:
        size = rnd.choice([1, 3, 50, 1000])
        out.append(text[at : at + size])
        at += size
    return out


def random_text(rnd):
    words = ["word", "a.", "b!", "Why?", "é", "é", "“q”", "x—y", "​z", "Mr.\t", "...", "cookies", "advertisement"]
    text = ""
    for _ in range(rnd.randint(0, 60)):
        text += " ".join(rnd.choices(words, k=rnd.randint(0, 12)))
        text += rnd.choice([" ", "\n", "\n", "\n\n", "\n \n", "\n\n\n\n", "\n   ", ".\n   ", "\nAccept all cookies\n"])
    return text


def test_documents_in_pieces_have_the_chunks_of_whole_ones(spark):
    rnd = random.Random(9)
    texts = [random_text(rnd) for _ in range(60)] + ["", " \n ", "one. " * 3000, "w " * 500 + "\n" + "v. " * 500, "line\n" * 400]
    docs = spark.createDataFrame(
        [(3 * k, "s", "file_txt", t) for k, t in enumerate(texts)], "doc_seq bigint, source string, source_type string, raw_text string"
    )
    pieces = spark.createDataFrame(
        [(3 * k, n, p) for k, t in enumerate(texts) for n, p in enumerate(cut(rnd, t))], "doc_seq bigint, piece_no bigint, raw_text string"
    )
    for most in (5, 60):
        whole = chunk_documents(clean_documents(docs), max_tokens=most).select("doc_seq", "chunk_index", "total_chunks", "text")
        found = L.chunk_long_documents(pieces, max_tokens=most)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert L.chunk_long_documents(pieces.limit(0)).collect() == []


def test_one_document_packs_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 512)
    written = {}

    def recorded(df, path):
        written[path.rpartition("/")[2].rpartition("-")[0]] = path.removeprefix("file:")
        return materialize(df, path)

    monkeypatch.setattr(L, "materialize", recorded)
    # small tables would be put together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    lines = [f"Sentence number {k} of this text. And {k % 7} more" for k in range(6000)]
    text = "\n".join(lines)
    pieces = [(0, n, text[at : at + 9000]) for n, at in enumerate(range(0, len(text), 9000))]
    df = spark.createDataFrame(pieces, "doc_seq bigint, piece_no bigint, raw_text string").repartition(6)
    found = L.chunk_long_documents(df, max_tokens=200).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert " ".join(r.text for r in sorted(found, key=lambda r: r.chunk_index)).split() == text.split()
    assert {r.total_chunks for r in found} == {len(found)} and len(found) > 100
    assert len(list(Path(written["unit-places"]).glob("part-*.parquet"))) > 3


def test_pieces_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        made.add(1)
        return text

    rows = [(doc, n, f"A line. And more\nof {n}\n\nthe end") for doc in range(20) for n in range(5)]
    pieces = spark.createDataFrame(rows, "doc_seq bigint, piece_no bigint, raw_text string")
    found = L.chunk_long_documents(pieces.withColumn("raw_text", counted("raw_text")), max_tokens=20)
    assert found.select("doc_seq").distinct().count() == 20
    assert made.value == len(rows)


def test_blocks_of_lines_cut_paragraphs_anywhere(spark, monkeypatch):
    monkeypatch.setattr(L, "LINES", 3)
    monkeypatch.setattr(L, "BLOCK", 4)
    rnd = random.Random(5)
    texts = [random_text(rnd) for _ in range(12)] + ["", "one two\n" * 40, "one. " * 50 + "\n" * 9 + "two.\n" * 30]
    docs = spark.createDataFrame(
        [(k, "s", "file_txt", t) for k, t in enumerate(texts)], "doc_seq bigint, source string, source_type string, raw_text string"
    )
    pieces = docs.selectExpr("doc_seq", "0L AS piece_no", "raw_text")
    for most in (5, 60):
        whole = chunk_documents(clean_documents(docs), max_tokens=most).select("doc_seq", "chunk_index", "total_chunks", "text")
        found = L.chunk_long_documents(pieces, max_tokens=most)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_pieces_of_documents(spark):
    texts = ["", None, "a", "é😀" * 7, "x" * 20, "one\r\ntwo\rthree\n\n" * 3, " \x85\x00" * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_seq bigint, raw_text string")
    for size in (1, 5, 20):
        found = document_pieces(docs, size).collect()
        for k, text in enumerate(texts):
            own = [r.raw_text for r in sorted(found, key=lambda r: r.piece_no) if r.doc_seq == k]
            plain = text and text.replace("\r\n", "\n").replace("\r", "\n")
            assert own == ([plain[at : at + size] for at in range(0, len(plain), size)] if plain else [text])
