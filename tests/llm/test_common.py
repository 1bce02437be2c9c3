"""Batches are cut by bytes, so that long texts do not add up."""

import random

import pyarrow as pa
import pytest

from docsheaf.llm import common, credentials, filter_audit, line_quality, simhash
from docsheaf.llm.common import batches, cuts


@pytest.mark.parametrize("seed", range(5))
def test_cuts(seed, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 1000)
    rnd = random.Random(seed)
    sizes = [rnd.choice([None, 0, 10, 400, 999, 1000, 1001, 5000]) for _ in range(rnd.choice([0, 1, 100]))]
    text = pa.array([None if n is None else "x" * n for n in sizes], pa.string())
    inner = pa.StructArray.from_arrays([pa.array(["ab"] * len(sizes), pa.string())], ["note"])
    part = pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int64()), text, inner], ["doc_id", "text", "row"])
    found = list(cuts(part, 7))
    assert [a for a, _ in found[1:]] == [b for _, b in found[:-1]]
    assert (found[0][0], found[-1][1]) == (0, len(sizes)) if sizes else not found
    for a, b in found:
        assert a < b <= a + 7
        assert b == a + 1 or sum((n or 0) + 2 for n in sizes[a:b]) <= 1000
    # sliced batches too
    tail = part.slice(len(sizes) // 2)
    assert sum(b - a for a, b in cuts(tail, 7)) == tail.num_rows


def test_rows_come_out_as_they_went_in(monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 50)
    part = pa.RecordBatch.from_arrays([pa.array(["x" * (k % 30) for k in range(200)])], ["text"])
    seen = []

    def function(own):
        seen.append(own.num_rows)
        return [own.column("text")]

    out = pa.Table.from_batches(list(batches(function, ["text"])([part])))
    assert out.column("text").to_pylist() == part.column("text").to_pylist() and max(seen) < 200


def test_texts_of_twenty_megabytes(table):
    rnd = random.Random(1)
    words = [f"w{k}" for k in range(3000)] + ["password=Zk39fjQ02mxP"]
    long = " ".join(rnd.choices(words, k=3_600_000))
    docs = table([(k, long) for k in range(3)] + [(9, "short text")])
    assert len(long) > 19_000_000
    assert {r.n_assign for r in credentials.digest(credentials.find_secrets(docs)).collect()} == {0, long.count("password=")}
    groups = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in groups) == [(0, 0), (1, 0), (2, 0), (9, 9)]
    assert line_quality.judged(docs, None).filter("n_words = 3600000").count() == 3
    masks = {r.doc_id: r["mask"] for r in filter_audit.with_copies(filter_audit.failures(docs.selectExpr("*", "'en' lang"))).collect()}
    assert masks == {0: 2, 1: 18, 2: 18, 9: 1}


def test_staged_tables_leave_no_shuffle_files(spark):
    import time

    from docsheaf.llm.common import staged

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for k in range(files.getAllFiles().size()) if "shuffle_" in (f := str(files.getAllFiles().apply(k)))}
    there = shuffled()
    assert len(staged(spark.range(1000).repartition(7, "id"), "dealt").collect()) == 1000
    until = time.monotonic() + 10
    while (left := {f for f in shuffled() - there if ".data" in f}) and time.monotonic() < until:
        time.sleep(0.5)
    assert not left and spark.conf.get(key, None) == before
