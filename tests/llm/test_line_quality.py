import random
import re

import numpy as np

from docsheaf.llm import line_quality as lq

WORD = re.compile(r"[^ \t-\r]+")


def counts(text):
    words = WORD.findall(text or "")
    places = {}
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for own in places.values() if len(own) > 1 for k in own for j in range(8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered), failed


def check(df, chain=None):
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = lq.digest(lq.judged(df, chain)).collect()
    for r in rows:
        assert tuple(r[1:7]) == counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    return rows


def test_counts(table):
    rnd = random.Random(9)
    pieces = ["a", "b", "é#", " ", " ", "\n", "\t", "one two three four five six seven eight", "|", "😀"]
    rows = [(k, "".join(rnd.choices(pieces, k=rnd.randint(0, 80)))) for k in range(300)]
    check(table(rows))


def test_odd_rows(odd, odd_extra, empty):
    assert len(check(odd)) == 9
    found = lq.judged(odd_extra, None)
    assert found.select("row.*").columns == odd_extra.columns and found.count() == 9
    assert lq.judged(empty, None).collect() == []


def test_viterbi_is_the_best_labelling():
    rnd = np.random.default_rng(0)
    lengths = np.array([0, 1, 5, 3, 6])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    scores = rnd.normal(size=(starts[-1], 2))
    chain = lq.Chain(np.zeros((1, 2)), rnd.normal(size=(2, 2)), rnd.normal(size=2))
    labels = lq.viterbi(scores, starts, chain)

    def value(own, own_scores):
        total = chain.first[own[0]] + sum(own_scores[k, label] for k, label in enumerate(own))
        return total + sum(chain.step[a, b] for a, b in zip(own, own[1:], strict=False))

    for a, b in zip(starts, starts[1:], strict=False):
        if a < b:
            best = max(
                ([n >> k & 1 for k in range(b - a)] for n in range(1 << (b - a))),
                key=lambda own: value(own, scores[a:b]),
            )
            assert labels[a:b].tolist() == best


def test_held_out_accuracy(spark):
    """Fitted on documents with even identifiers, judged on the others."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = lq.train(docs, labels.filter("doc_id % 2 = 0"))
    found = lq.judged(docs.select("doc_id", "text"), chain).select("row.doc_id", "kept", "base_failed")
    rows = found.join(labels, "doc_id").filter("doc_id % 2 = 1 and not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert right >= 0.95 * len(rows)


def test_without_labels(table, spark):
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id bigint, quality int")
    assert lq.train(table([(1, "a b"), (2, "c")]), labels) is None
