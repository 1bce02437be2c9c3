import hashlib
import math
import random

import numpy as np
import pytest

from docsheaf.llm import vector_codes as vc

NAMES = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """All steps by hand, in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    size = -(-max((len(r[1]) for r in kept), default=0) // parts) * parts
    width = size // parts
    cells = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] + [0] * (size - len(r[1])) for r in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    part = lambda k, p: cells[k][p * width : (p + 1) * width]
    books = [[part(k, p) for k in first] for p in range(parts)]

    def nearest(own, book):
        return min((sum((a - b) ** 2 for a, b in zip(own, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for k in range(len(kept)):
                groups.setdefault(nearest(part(k, p), books[p])[1], []).append(part(k, p))
            for e, own in groups.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    joined = ",".join(str(x) for book in books for entry in book for x in entry)
    out = []
    for k, r in enumerate(kept):
        found = [nearest(part(k, p), books[p]) for p in range(parts)]
        out.append([r[0], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), r[2]])
    total = {}
    for row in out:
        total[row[3]] = total.get(row[3], 0) + row[2]
    sha = hashlib.sha256(joined.encode()).hexdigest()
    return sorted([(i, code, error, total[label], sha) for i, code, error, label in out], key=str)


def result(df):
    return sorted([tuple(r) for r in vc.digest(df).collect()], key=str)


def test_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(k, [rnd.gauss(k % 3, 0.2) for _ in range(64)], rnd.choice([1, 2, None])) for k in range(150)]
    rows += [(k, [float(rnd.randint(-1, 1)) for _ in range(64)], 1) for k in range(200, 260)]
    assert result(spark.createDataFrame(rows, NAMES)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 40])
def test_sizes_of_table_and_vector(spark, n):
    rnd = random.Random(n)
    for size in (0, 3, 8, 24):
        rows = [(k, [rnd.uniform(-2, 2) for _ in range(size)], None) for k in range(n)]
        assert result(spark.createDataFrame(rows, NAMES)) == brute(rows)


def test_odd_rows(spark):
    whole = [0.5, -0.25, 1.0, 0.0, 2.0, -3.5, 0.125, 9.0]
    rows = [
        (None, whole, 1), (3, None, 1), (4, [None, *whole[1:]], 1), (5, [math.nan, *whole[1:]], 1),
        (6, [math.inf, *whole[1:]], 1), (7, whole, 2), (7, whole, 2), (7, whole[::-1], None), (8, whole[:3], None),
        (9, [], 3), (2, [-x for x in whole], 1), (1, whole, 1),
    ]
    assert result(spark.createDataFrame(rows, NAMES)) == brute(rows)
    assert result(spark.createDataFrame([], NAMES)) == []
    assert result(spark.createDataFrame([(1, None, 1), (2, [math.nan], 1)], NAMES)) == []
    wide = spark.createDataFrame(
        [(*r, None, "x", 1) for r in rows], NAMES + ", code string, error string, `_label` int"
    )
    assert result(wide) == brute(rows)


def test_very_large_components_end_at_the_bound(spark):
    rows = [(k, [3e38 * (-1) ** k, 1.0, *[0.0] * 6], 1) for k in range(20)]
    found = vc.digest(spark.createDataFrame(rows, NAMES)).collect()
    assert len(found) == 20 and {r.error for r in found} == {0}
    assert len({r.code for r in found}) == 2


@pytest.mark.parametrize("width", [1, 2, 3, 8, 40, 70])
def test_hilbert_keys_tell_cells_apart_and_keep_neighbours_near(width):
    rnd = np.random.default_rng(width)
    points = rnd.integers(0, 1 << 10, (500, width))
    keys = vc.hilbert_keys(points)
    assert (keys >= 0).all()
    if width == 2:
        # along the curve through all cells of a square each step goes to a neighbour
        side = 16
        cells = np.array([(a, b) for a in range(side) for b in range(side)])
        order = cells[np.argsort(vc.hilbert_keys(cells))]
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        values = rnd.integers(-40, 40, (300, 4)) + rnd.integers(-100, 100, 4)
        entries = rnd.integers(-120, 120, (16, 4))
        starts = np.arange(0, 300, 50)
        low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
        lists = vc.shortlists(low, high, entries)
        code, far = vc.nearest(values, np.full(6, 50), lists, entries)
        every = ((values[:, None] - entries) ** 2).sum(axis=2)
        assert (far == every.min(axis=1)).all() and (code == every.argmin(axis=1)).all()


def test_several_chunks_give_what_one_gives(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    whole = result(rows)
    monkeypatch.setattr(vc, "CHUNK_ROWS", 37)
    monkeypatch.setattr(vc, "BLOCK", 5)
    assert result(rows.repartition(4)) == whole
