"""Every stage of the pipeline against brute force, on the whole smallest tables."""

import pytest
from test_line_quality import counts
from test_line_runs import brute
from test_simhash import fingerprint, linked

import corpus_pipeline as cp
from docsheaf.llm import line_quality, mixing
from docsheaf.llm.common import staged
from docsheaf.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in cp.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF), name))
    return docs


def test_order_and_columns(steps):
    assert [name for name, _ in cp.STAGES] == ["quality", "lines", "near_duplicates", "mixture", "encode"]
    assert all(df.schema == steps[0].schema for df in steps[1:-1])


def test_quality(spark, steps):
    kept = {r.doc_id for r in steps[1].collect()}
    rows = {r.doc_id: r.text for r in steps[0].collect()}
    assert not any(counts(rows[doc])[5] for doc in kept)
    judged = line_quality.judged(steps[0], line_quality.train(steps[0], spark.read.parquet(f"{SF}/labels.parquet")))
    assert kept == {r.doc_id for r in judged.filter("kept").select("row.doc_id").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    lost = {doc for doc in clean & set(rows) - kept if not counts(rows[doc])[5]}
    assert len(lost) <= 0.03 * len(clean)


def test_lines(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    expected = {doc: text for (doc, _), (text, n, gone) in brute(rows, 50).items() if not gone or gone < n}
    assert {r.doc_id: r.text for r in steps[2].collect()} == expected
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_duplicates(steps):
    rows = {r.doc_id: r.text for r in steps[2].collect()}
    fps = {doc: fingerprint(text) for doc, text in rows.items()}
    least = linked(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {r.doc_id: r.text for r in steps[3].collect()} == {doc: rows[doc] for doc in rows if least[doc] == doc}


def test_mixture(steps):
    found = mixing.mixed(steps[3]).select("row.doc_id", "slot", "in_mix", "_order", "_doc").collect()
    chosen = sorted((r for r in found if r.in_mix), key=lambda r: (r.slot, r[3], r[4]))
    assert sorted(r.doc_id for r in steps[4].collect()) == sorted(r.doc_id for r in chosen)
    assert [r.doc_id for r in mixing.in_order(mixing.mixed(steps[3])).collect()] == [r.doc_id for r in chosen]


def test_ids_are_written_in_the_order_of_the_mixture(spark, steps):
    found = mixing.in_order(mixing.mixed(steps[3])).select("doc_id").collect()
    rows = steps[5].select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r[1:])] == [r.doc_id for r in found]


def test_encode(steps):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert {r.doc_id: r.ids for r in rows} == {doc: model.encode(text) for doc, text in texts.items()}
    assert all(r.decoded_equal for r in rows)


def test_odd_rows(spark, odd_extra):
    for rows in (odd_extra, odd_extra.filter("false")):
        docs = rows
        for name, stage in cp.STAGES:
            docs = staged(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "ids", "n_pieces", "decoded_equal"]
