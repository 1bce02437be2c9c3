import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docsheaf.llm import ngram_model as nm


def brute(rows):
    tokens = [
        (doc, re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]) for doc, text in rows
    ]
    held = [doc is None or zlib.crc32(str(doc).encode()) % 10 == 0 for doc, _ in rows]
    counts = Counter(w for h, (_, own) in zip(held, tokens, strict=True) if not h for w in own)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for h, (doc, own) in zip(held, tokens, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        out.append((doc, h, len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    return sorted(out, key=str)


def result(df, **settings):
    rows = nm.scores(df, **settings).collect()
    assert all(r.score <= 0 for r in rows)
    return sorted([(*r[:5], round(r.base_score, 6)) for r in rows], key=str)


def test_base_scores(table, odd):
    rnd = random.Random(8)
    words = ["A", "b", "É", "the", "THE", "x1", "日本"]
    rows = [(k, " ".join(rnd.choices(words, k=rnd.randint(0, 30)))) for k in range(300)]
    assert result(table(rows)) == brute(rows)
    assert result(odd) == brute([tuple(r) for r in odd.collect()])


def test_both_ways_give_the_same_scores(table):
    rnd = random.Random(8)
    rows = [(k, " ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 30)))) for k in range(300)]
    sent = {r.doc_id: r.score for r in nm.scores(table(rows)).collect()}
    asked = {r.doc_id: r.score for r in nm.scores(table(rows), broadcast_bytes=0).collect()}
    assert sent == asked


def test_extra_columns_and_empty(odd_extra, empty):
    assert nm.scores(odd_extra).count() == 9
    assert nm.scores(empty).collect() == []
    assert nm.scores(empty, broadcast_bytes=-1).collect() == []


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_filter_reads_at_least_what_it_holds(n):
    rnd = np.random.default_rng(n)
    keys = rnd.integers(0, 1 << 63, n).astype(np.uint64)
    counts = (2.0 ** rnd.uniform(0, 20, n)).astype(np.int64)
    bits = nm.build_filter(keys, counts)
    levels = nm.read_levels(keys, bits, 0, len(bits) * 8)
    exact = np.floor(np.log2(np.maximum(counts, 1))).astype(int) + 1
    assert (levels >= exact).all()
    if n:
        assert (levels == exact).mean() > 0.85
        absent = nm.read_levels(rnd.integers(0, 1 << 63, 20_000).astype(np.uint64), bits, 0, len(bits) * 8)
        assert (absent > 0).mean() < 0.1


def test_pairs_beat_words_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = nm.scores(docs).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def exact_scores(rows):
    """Scores of all texts with exact pair counts put through the levels: what a filter without false positives gives."""
    tokens = {doc: [*re.findall(r"[^ \t-\r]+", text.lower()), "\n"] for doc, text in rows}
    train = {doc: own for doc, own in tokens.items() if zlib.crc32(str(doc).encode()) % 10}
    words = Counter(w for own in train.values() for w in own)
    pairs = Counter(p for own in train.values() for p in zip([" ", *own], own, strict=False))
    total, times = sum(words.values()), words | {" ": words["\n"]}
    out = {}
    for doc, own in tokens.items():
        out[doc] = 0.0
        for a, b in zip([" ", *own], own, strict=False):
            n = pairs[a, b]
            mean = 1.5 * 2.0 ** math.floor(math.log2(n)) - 0.5 if n else 0.0
            base = (words[b] + 0.1) / (total + 0.1 * (len(words) + 1))
            seen = min(mean, times.get(a, 0), words[b])
            out[doc] += math.log10((seen + nm.PRIOR * base) / (times.get(a, 0) + nm.PRIOR))
    return out


@pytest.mark.parametrize("sent", [nm.BROADCAST_BYTES, 0])
def test_scores_against_exact_pair_counts(table, sent):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(rnd.choices(words, [1 / (j + 1) for j in range(300)], k=rnd.randint(0, 60)))) for k in range(600)]
    exact = exact_scores(rows)
    found = {r.doc_id: r.score for r in nm.scores(table(rows), broadcast_bytes=sent).collect()}
    # a false positive raises a pair's chance and nothing lowers it
    assert all(found[doc] >= score - 1e-9 for doc, score in exact.items())
    tokens = sum(len(text.split()) + 1 for _, text in rows)
    assert sum(found.values()) - sum(exact.values()) < 0.05 * tokens
    assert sum(math.isclose(found[doc], score, abs_tol=1e-9) for doc, score in exact.items()) > 60


def test_shards_follow_the_corpus(table, monkeypatch):
    rnd = random.Random(5)
    rows = [(k, " ".join(f"x{rnd.randrange(3000)}" for _ in range(100))) for k in range(200)]
    wide = {r.doc_id: r.score for r in nm.scores(table(rows)).collect()}
    monkeypatch.setattr(nm, "SAMPLED", 4)
    monkeypatch.setattr(nm, "SHARD_WORDS", 50)
    shards = nm.shards_for(nm.tokenised(table(rows)))
    assert 30 < shards.words < 120 and shards.pairs == nm.LEAST_SHARDS
    assert wide.keys() == {r.doc_id for r in nm.scores(table(rows), broadcast_bytes=0).collect()}


def test_rows_come_to_python_a_few_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        docs = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id bigint, text string")
        assert nm.scores(docs).count() == 2
        assert int(spark.conf.get(key).rstrip("b")) <= nm.ROWS_BYTES == 4 << 20
    finally:
        spark.conf.unset(key)


def test_blocks_are_cut_and_answered_many_at_once(monkeypatch):
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    shards = nm.Shards(16, 700)
    rows = []
    for k in range(40):
        words = rnd.integers(0, 1 << 63, 200).astype(np.uint64)
        starts = np.array([0, 900, 1000])
        tokens = nm._to_planes(rnd.integers(2, 200, 1000))
        rows.append({"batch": k, "held": [False, True], "starts": starts.tobytes(), "tokens": tokens, "words": words.tobytes()})
    made = list(nm._pair_blocks(shards, iter([pa.RecordBatch.from_pylist(rows)])))
    # a batch's blocks for all shards come together
    assert len(made) == 40 and sum(part.num_rows for part in made) > 40 * 400
    ordered = pa.Table.from_batches(made).sort_by("shard").combine_chunks().to_batches()[0]
    calls, real = [], nm.read_levels
    monkeypatch.setattr(nm, "read_levels", lambda *args: calls.append(1) or real(*args))
    found = pa.Table.from_batches(list(nm._pair_answers(iter([ordered.slice(0, 9000), ordered.slice(9000)])))).to_pylist()
    assert len(calls) <= 700 < len(found) == ordered.num_rows
    sizes = {(r["batch"], r["shard"]): len(r["keys"]) // 8 for r in ordered.to_pylist()}
    assert {(r["batch"], r["shard"]): len(r["found"]) for r in found} == sizes
    # pairs trained on have a level in the answers that a batch puts together again
    for row in rows[:3]:
        batch = nm.Batch(row)
        keys = np.unique(batch.pairs)
        levels = nm._restored(keys, 700, [r for r in found if r["batch"] == row["batch"]], np.uint8)
        assert (levels[np.searchsorted(keys, batch.pairs[:900])] > 0).all() and (levels == 0).any()
