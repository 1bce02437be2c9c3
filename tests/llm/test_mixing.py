import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docsheaf.llm import mixing as mx


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 1.7, "d": 0.001}, {c: 1 for c in "abcdefg"}])
def test_period_deviates_by_less_than_a_block(weights):
    slots = mx.shares(weights, 120)
    assert sum(slots.values()) == 120 and min(slots.values()) >= 1
    taken = Counter()
    for t, (source, j, release, deadline, slot) in enumerate(mx.period(slots)):
        assert slot == t and release <= slot < deadline and j == taken[source]
        taken[source] += 1
        assert all(abs(taken[s] - k * (t + 1) / 120) < 1 for s, k in slots.items())


def test_schedule_of_documents(spark):
    rnd = random.Random(6)
    rows = [(k, "hot" if k % 3 else f"s{k % 4}", "w " * rnd.randint(0, 30)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, block_words=20, resolution=50)).collect()
    assert sorted(r.doc_id for r in found) == list(range(400))
    # sources are cut without gaps: words before a document decide its block
    by_block = {}
    for r in found:
        assert r.release <= r.slot < r.deadline
        by_block.setdefault((r.source, r.block), set()).add(r.slot)
    assert all(len(s) == 1 for s in by_block.values())
    slots = [next(iter(s)) for s in by_block.values()]
    assert len(slots) == len(set(slots))
    totals = Counter()
    for r in found:
        totals[r.source] += r.words
    slots = mx.shares({s: n**mx.SMOOTHING for s, n in totals.items()}, 50)
    plan = {(s, j): slot for s, j, _, _, slot in mx.period(slots)}
    end = min(-(-totals[s] // 20) // k * 50 + plan[s, -(-totals[s] // 20) % k] for s, k in slots.items())
    assert all(r.in_mix == (r.slot < end) for r in found)
    # what is in the mixture holds the weights
    words = Counter()
    for r in found:
        if r.in_mix:
            words[r.source] += r.words
    for s, k in slots.items():
        assert abs(words[s] - end * 20 * k / 50) <= 20 + 60


def test_given_weights_leave_other_sources_out(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "x"), (3, None, "z")], "doc_id bigint, source string, text string")
    found = {r.doc_id: r for r in mx.digest(mx.mixed(docs, weights={"a": 1.0, "": 1.0})).collect()}
    assert not found[2].in_mix and found[2].slot is None
    assert found[1].in_mix and found[3].in_mix
    kept = mx.in_order(mx.mixed(docs, weights={"a": 1.0, "": 1.0}))
    assert kept.columns == docs.columns and kept.count() == 2


def test_odd_rows(odd_extra):
    found = mx.mixed(odd_extra)
    assert found.count() == 9 and mx.in_order(found).columns == odd_extra.columns
    assert mx.mixed(odd_extra.filter("false")).collect() == []


def test_whole_mixture_goes_on_without_small_sources(spark):
    rows = [(k, "hot" if k % 3 else f"s{k % 4}", "w " * (k % 40 + 20)) for k in range(1, 400)]
    rows += [(1000, "tiny", "w w w"), (1001, None, "w"), (1002, "blank", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, block_words=20)).collect()
    assert len(found) == len(rows) and all(r.in_mix for r in found)
    assert all(r.release <= r.slot < r.deadline for r in found)
    slots = {}
    for r in found:
        slots.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(of) == 1 for of in slots.values())
    assert not all(r.in_mix for r in mx.digest(mx.mixed(docs, block_words=20, whole=False)).collect())
    assert mx.in_order(mx.mixed(docs, block_words=20)).count() == len(rows)


def test_phases_deviate_by_less_than_a_block():
    blocks = {0: 5000, 1: 700, 2: 1, 3: 40, 4: 41, 5: 3}
    weights = {s: n**0.7 for s, n in blocks.items()}
    order = []
    for plan, first, base, slots, end in mx.phases(weights, blocks, None, True):
        assert base == len(order)
        length, taken = sum(slots.values()), Counter()
        where = {slot: (s, j) for s, j, _, _, slot in plan}
        for t in range(end):
            s, j = where[t % length]
            assert first[s] + t // length * slots[s] + j == first[s] + taken[s] < blocks[s]
            taken[s] += 1
            order.append(s)
            assert all(abs(taken[x] - k * (t + 1) / length) < 1 for x, k in slots.items())
    assert Counter(order) == blocks


def test_many_sources(spark):
    rows = [(k, f"host{k % 2500}", "w " * (k % 7 + 1)) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, block_words=5)).collect()
    assert len(found) == 6000 and all(r.in_mix and r.release <= r.slot < r.deadline for r in found)
    slots = {}
    for r in found:
        slots.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(of) == 1 for of in slots.values())


def test_members_of_a_class_take_turns(spark):
    rnd = random.Random(2)
    words = {f"s{k:03}": rnd.choice([3, 40, 41, 44, 900, 1000]) + rnd.randint(0, 3) for k in range(300)}
    sources = spark.createDataFrame(list(words.items()), "_source string, words bigint")
    table, weights, sizes = mx.classes(mx._counted(sources, 0.7, None, 5, True))
    rows = table.collect()
    assert len(rows) == 300 and len(weights) <= mx.CLASSES
    total = sum(n**0.7 for n in words.values())
    assert abs(sum(weights.values()) - total) < 1e-6 * total
    for c, of in sizes.items():
        own = [r for r in rows if r._c == c]
        assert sorted(r._turn for r in own) == list(range(sum(of.values())))
        # weights of a class are alike
        each = [words[r._source] ** 0.7 for r in own]
        assert max(each) <= 1.2 * min(each)
        # in every round the members that have blocks take a slot each, without gaps between rounds
        frame = spark.createDataFrame([(r._turn, j, sorted(of.items())) for r in own for j in range(r._blocks)],
                                      "turn bigint, j bigint, sizes array<struct<size:bigint,n:bigint>>")
        found = frame.select("j", (mx.before_round(F.col("sizes"), F.col("j")) + F.col("turn")).alias("slot")).collect()
        slots = sorted(r.slot for r in found)
        assert len(set(slots)) == len(slots) and slots[0] == 0
        assert slots[-1] < sum(size * n for size, n in of.items()) <= len(slots) * (1 + 1 / mx.STEPS)
        assert [j for j, _ in sorted((r.j, r.slot) for r in found)] == [r.j for r in sorted(found, key=lambda r: r.slot)]


def test_very_many_sources_of_unlike_sizes(spark):
    import time

    rnd = random.Random(4)
    sources = spark.range(20_000).select(
        F.concat(F.lit("host"), F.col("id")).alias("_source"),
        (F.pow(F.lit(10.0), F.rand(7) * 6) + 1).cast("bigint").alias("words"),
    )
    rows = [(r._source, r.words) for r in sources.collect()]
    sources = spark.createDataFrame(rows, "_source string, words bigint")
    counted = mx._counted(sources, mx.SMOOTHING, None, mx.BLOCK_WORDS, True)
    table, weights, sizes = mx.classes(counted)
    assert table.count() == 20_000 and len(weights) <= mx.CLASSES
    began = time.monotonic()
    blocks = {c: sum(n * k for n, k in of.items()) for c, of in sizes.items()}
    made = list(mx.phases(weights, blocks, None, True))
    assert sum(len(plan) for plan, *_ in made) < 600_000 and time.monotonic() - began < 30
    assert len(made) <= len(weights)
    # each class is within one block of its share at the end of every phase
    taken, at = Counter(), 0
    for plan, first, base, slots, end in made:
        assert base == at and first == {c: taken[c] for c in slots}
        length, at = sum(slots.values()), base + end
        rest = Counter(c for c, *_, slot in plan if slot < end % length)
        for c, k in slots.items():
            got = end // length * k + rest[c]
            assert abs(got - end * k / length) < 1
            taken[c] += got
    assert taken == blocks
    docs = spark.createDataFrame([(k, f"host{rnd.randrange(3000)}", "w " * rnd.choice([1, 9, 400])) for k in range(4000)],
                                 "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, block_words=50)).collect()
    assert len(found) == 4000 and all(r.in_mix and r.release <= r.slot < r.deadline for r in found)
    of_slot = {}
    for r in found:
        of_slot.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(of) == 1 for of in of_slot.values())


def test_one_rule_for_any_number_of_sources(spark):
    # 60 alike sources, and the same with ten more: members of a class in turns in either case
    for n in (3, 60, 70):
        rows = [(100 * s + k, f"s{s:02}", "w " * 10) for s in range(n) for k in range(4)]
        docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
        found = mx.digest(mx.mixed(docs, block_words=10)).collect()
        assert sorted(r.slot for r in found) == list(range(4 * n))
        order = [(r.block, r.source) for r in sorted(found, key=lambda r: r.slot)]
        assert order == sorted(order)


def test_a_resolution_has_every_source_on_its_own(spark):
    rows = [(100 * s + k, f"s{s:02}", "w " * 10) for s in range(70) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, block_words=10, resolution=140, whole=True)).collect()
    assert len(found) == 140 and all(r.in_mix and r.release <= r.slot < r.deadline for r in found)
    with pytest.raises(ValueError):
        mx.mixed(docs, block_words=10, resolution=60)


def test_sources_of_like_weight_have_their_own(spark):
    rows = [(1000 * s + k, f"s{s}", "w " * 10) for s in range(2) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = mx.digest(mx.mixed(docs, weights={"s0": 1.0, "s1": 1.15}, block_words=10)).collect()
    order = [r.source for r in sorted(found, key=lambda r: r.slot)]
    for t in range(1, 500):
        assert abs(order[:t].count("s0") - t / 2.15) < 1
    part = mx.digest(mx.mixed(docs, weights={"s0": 1.0, "s1": 1.15}, block_words=10, whole=False)).collect()
    assert {(r.doc_id, r.slot) for r in part} == {(r.doc_id, r.slot) for r in found}
    # s1 runs out first, and s0 has had its share by then
    assert abs(sum(r.in_mix for r in part) - 300 * 2.15 / 1.15) <= 1


@pytest.mark.parametrize("n, largest", [(1, 9000), (25, 3000), (3000, 9)])
def test_every_source_has_its_own_share_at_every_slot(spark, n, largest):
    rnd = random.Random(n)
    blocks = {c: rnd.randint(1, largest) for c in range(n)}
    weights = {c: rnd.choice([0.01, 1, 1.1, 300]) * (1 + rnd.random()) if n < 100 else 1 + rnd.random() for c in blocks}
    sources = spark.createDataFrame([(c, weights[c], b) for c, b in blocks.items()], "_c bigint, weight double, blocks bigint")
    found = sorted(mx.framed(sources).collect(), key=lambda r: r.slot)
    assert [r.slot for r in found] == list(range(sum(blocks.values())))
    assert all(r.release <= r.slot < r.deadline for r in found)
    # one factor gives every source its weight, or all it has, to less than two blocks
    taken, at = Counter(), 0
    for r in found:
        assert r.block == taken[r._c]
        taken[r._c] += 1
        at += 1
        if n < 100 or at % 500 == 0:
            least = max((taken[c] - 2) / weights[c] for c in blocks)
            most = [(taken[c] + 2) / weights[c] for c, b in blocks.items() if taken[c] + 2 <= b]
            assert least < min(most, default=least + 1)
