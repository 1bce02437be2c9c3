import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docsheaf.operators import report as R
from docsheaf.operators import top_names as N
from docsheaf.plans import inputs
from docsheaf.functions.replies import parse_replies
from docsheaf.operators.results import result_records


def expected(rows, n):
    counts, first = Counter((g, name) for g, name, _ in rows), {}
    for g, name, place in rows:
        first[g, name] = min(place, first.get((g, name), place))
    out = []
    for g in {g for g, _, _ in rows}:
        names = sorted((k for k in counts if k[0] == g), key=lambda k: (-counts[k], first[k]))[:n]
        out += [(*k, counts[k], first[k]) for k in names]
    return sorted(out)


def first_ones(found, n):
    by_group = {}
    for r in sorted(found.collect(), key=lambda r: (-r.n, r.place)):
        by_group.setdefault(r.grp, []).append(tuple(r))
    return sorted(row for rows in by_group.values() for row in rows[:n])


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_a_full_count(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(N, "HELD_NAMES", rnd.choice([3, 1 << 20]))
    flat = rnd.random() < 0.4
    names = [f"n{k}" for k in range(60)]
    weights = [1] * 60 if flat else [1 / (k + 1) ** 2 for k in range(60)]
    rows = [(rnd.choice([0, 0, 2]), rnd.choices(names, weights)[0], p) for p in range(rnd.choice([0, 5, 900]))]
    # one task may hold what no other has
    rows.sort(key=lambda r: r[1] if seed % 2 else r[2])
    table = spark.createDataFrame(rows, "grp int, name string, place bigint").repartitionByRange(5, "name" if seed % 2 else "place")
    for n in (1, 5):
        assert first_ones(N.candidate_counts(table, n), n) == expected(rows, n)


def test_few_names_are_shuffled(spark):
    results = result_records(parse_replies(inputs.replies(spark, "/root/testdata/sf0.1")))
    partial = N.partial_counts(R.mentions(results).repartition(16, F.col("place")))
    least = N.least_counts(partial, 5)
    every = partial.count()
    sent = partial.filter("local_rank <= 5").count()
    for grp, count in least.items():
        sent += partial.filter((F.col("grp") == grp) & (F.col("n") >= count)).count()
    assert sent * 10 < every
