import random
import re
from fractions import Fraction
from itertools import permutations

import pytest

from docsheaf.llm import filter_audit as fa

DOCS = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, quality int, toxic int"


def failures(rows):
    """The failed filters of every row, by the words of the contract."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^ \t-\r]+", text)
        failed = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows),
        }
        out.append({f for f, bad in failed.items() if bad})
    return out


def brute(rows, labels):
    failed = failures(rows)
    good = {doc for doc, q, _ in labels if q == 1 and doc is not None}
    toxic = {doc for doc, _, t in labels if t == 1 and doc is not None}
    out = []
    for part in {lang or "" for _, _, lang in rows}:
        own = [(doc, f) for (doc, _, lang), f in zip(rows, failed, strict=True) if (lang or "") == part]
        lines, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(doc, f) for doc, f in left if name in f]
                left = [(doc, f) for doc, f in left if name not in f]
                total[name] += len(gone)
                lines.append((
                    part, "".join(order), step, len(left), len(gone), sum(name in f for _, f in own) - len(gone),
                    sum(f == {name} for _, f in own), sum(doc in good for doc, _ in gone),
                    sum(doc in toxic for doc, _ in gone), name,
                ))
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out)


def result(spark, rows, labels, names=DOCS):
    docs = spark.createDataFrame(rows, names)
    return sorted(tuple(r) for r in fa.audited(docs, spark.createDataFrame(labels, LABELS)).collect())


def texts(rnd, n):
    words = ["a", "B", "CC", "é", "日本", "x#", "word", "Word", "1"]
    every = [" ".join(rnd.choices(words, k=rnd.choice([0, 3, 99, 100, 101]))) for _ in range(n // 2)]
    every += [" ".join(f"w{j}" for j in rnd.sample(range(500), rnd.choice([99, 100, 120]))) for _ in range(n // 2)]
    return every


def test_against_brute_force(spark):
    rnd = random.Random(1)
    own = texts(rnd, 40)
    rows = [(k, rnd.choice(own), rnd.choice(["en", "de", None])) for k in range(200)]
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in rnd.choices(range(220), k=150)]
    assert result(spark, rows, labels) == brute(rows, labels)


def test_odd_rows(spark):
    long = "word " * 30_000
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t", "en"), (None, "same text", "en"), (None, "same text", "en"),
        (5, "same text", "en"), (5, "same text", "en"), (7, "same text", "fr"), (8, long, "fr"), (9, long, ""),
        (4, "X" * 50_000, "fr"), (6, "é ü 日本 😀 AB", "de"),
    ]
    labels = [(None, 1, 1), (5, None, 1), (5, 1, None), (5, 0, 0), (7, 0, 1), (100, 1, 1)]
    assert result(spark, rows, labels) == brute(rows, labels)
    assert result(spark, rows, []) == brute(rows, [])
    assert result(spark, [], labels) == []
    more = [(*r, None, 1, True, b"x") for r in rows]
    names = DOCS + ", part string, mask int, good boolean, digest binary"
    assert result(spark, more, labels, names) == brute(rows, labels)


def test_weights_are_those_of_shapley():
    for n in range(1, 6):
        weights = fa.shapley_weights(n)
        sets = fa.coalitions(n)
        for k in range(n):
            exact = [Fraction(0)] * len(sets)
            orders = list(permutations(range(n)))
            for order in orders:
                before = sum(1 << f for f in order[: order.index(k)])
                exact[before] -= Fraction(1, len(orders))
                exact[before | 1 << k] += Fraction(1, len(orders))
            # the empty coalition removes nothing, so it needs no weight
            assert weights[k][1:] == exact[1:]


@pytest.mark.parametrize("filters", ["X", "PQ", "ABC"])
def test_any_number_of_filters(spark, filters):
    rnd = random.Random(2)
    rows = [(rnd.choice("uv"), rnd.randrange(1 << len(filters)), rnd.random() < 0.5, False) for _ in range(100)]
    found = fa.audit(spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean"), filters)
    for r in found.collect():
        before = sum(1 << filters.index(f) for f in r.filter_order[: r.step - 1])
        own = 1 << filters.index(r.filter_order[r.step - 1])
        mine = [row for row in rows if row[0] == r.part]
        assert r.kept == sum(not row[1] & (before | own) for row in mine)
        assert r.removed == sum(not row[1] & before and bool(row[1] & own) for row in mine)
        assert r.good_lost == sum(not row[1] & before and bool(row[1] & own) and row[2] for row in mine)
