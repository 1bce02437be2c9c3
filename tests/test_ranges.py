import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docsheaf.session import workspace
from docsheaf.sources import files, ranges


def random_bytes(rnd, n):
    """Valid and broken UTF-8, and newlines of all kinds."""
    bits = [b"a", "é".encode(), "日".encode(), "😀".encode(), b"\r\n", b"\r", b"\n", b"\xff", b"\xc3", b"\xed\xa0\x80", b"\xe0\x80",
            b"\xf4\x90", "﻿".encode(), "ࠀ".encode(), "\U0010ffff".encode()]
    good = [b for b in bits if valid(b)]
    return b"".join(rnd.choices(good if rnd.random() < 0.6 else bits, k=n))


def valid(raw):
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def text_of(raw):
    text = raw.decode() if valid(raw) else raw.decode("latin-1")
    return text.replace("\r\n", "\n").replace("\r", "\n")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64])
def test_maps_compose_and_pieces_join(size):
    rnd = random.Random(size)
    for _ in range(300):
        raw = random_bytes(rnd, rnd.randint(0, 40))
        parts = [raw[at : at + size] for at in range(0, len(raw), size)] or [b""]
        state = ranges.BETWEEN
        for part in parts:
            state = ranges.end_states(part)[state]
        assert (state == ranges.BETWEEN) == valid(raw)
        joined = ""
        for k, part in enumerate(parts):
            at = k * size
            joined += ranges.piece_text(raw[max(0, at - 1) : at], part, raw[at + len(part) : at + len(part) + 3], valid(raw))
        assert joined == text_of(raw)


def test_every_state_and_byte():
    for state in range(ranges.INVALID + 1):
        for byte in range(256):
            assert ranges.end_states(bytes([byte]))[state] == ranges.step(state, byte)
    assert ranges.end_states(b"") == list(range(9))


def contents(rnd):
    own = {f"f{k}.txt": random_bytes(rnd, rnd.choice([0, 1, 10, 400, 3000])) for k in range(30)}
    own |= {"sub/_x/deep.TXT": b"x" * 5000, "_hidden.txt": "é".encode() * 2000, "other.md": b"no", "p.pdf": b"%PDF"}
    # only the last byte is wrong
    own["late.txt"] = "é日".encode() * 1000 + b"\xc3"
    return own


def test_ranges_of_any_size_give_the_same_texts(spark):
    own, path = contents(random.Random(1)), workspace(spark, "ranges-in")
    table = spark.createDataFrame([(n, c) for n, c in own.items()], "source string, content binary")
    files.write_contents(table, path).count()
    expected = {n: text_of(c) for n, c in own.items() if n.lower().endswith(".txt")}
    for size in (7, 1000, 1 << 20):
        pieces, rejects = ranges.read_text_pieces(spark, path, range_bytes=size, split_bytes=20_000)
        found = {r.source.split("/", 1)[1].split("ranges-in-")[1][33:]: r.raw_text for r in ranges.joined_pieces(pieces).collect()}
        assert found == expected
        assert rejects.isEmpty()
    big = pieces.sparkSession.createDataFrame([("a", 10_000), ("b", 0), ("c", 150)], "source string, size bigint")
    cut = {(r.source, r.range_no): (r.start, r.length) for r in ranges.byte_ranges(big, 4000).collect()}
    assert cut == {("a", 0): (0, 4000), ("a", 1): (4000, 4000), ("a", 2): (8000, 2000), ("b", 0): (0, 0), ("c", 0): (0, 150)}


def test_splits_have_about_equal_bytes(spark):
    sizes = [1_000_000] + [1000] * 300
    table = spark.createDataFrame([(f"s{k:03}", n) for k, n in enumerate(sizes)], "source string, size bigint")
    dealt = ranges.in_splits(table, range_bytes=50_000, split_bytes=2_000_000)
    parts = dealt.rdd.glom().map(lambda rows: (sum(r.length + (r.start == 0) * ranges.OPEN_COST for r in rows), len(rows))).collect()
    assert sum(n for _, n in parts) == 320 and len(parts) == 11
    assert max(cost for cost, _ in parts) < 2 * 2_000_000


def test_files_that_cannot_be_read(spark):
    path = workspace(spark, "ranges-in")
    table = spark.createDataFrame([("a.txt", b"x" * 100), ("b.txt", b"y" * 100)], "source string, content binary")
    files.write_contents(table, path).count()
    listed = files.list_files(spark, path)
    # the listing says more than there is
    longer = listed.withColumn("size", listed["size"] + 50)
    for size in (60, 1000):
        scanned = ranges.scan_ranges(ranges.byte_ranges(files.route_files(longer), size))
        several = ranges.encodings(scanned)
        errors = several.filter("error is not null") if size == 60 else scanned.filter("error is not null")
        assert errors.select("source").distinct().count() == 2


def test_second_reading_is_dealt_out_by_bytes(spark):
    path = workspace(spark, "ranges-in")
    table = spark.createDataFrame([(f"f{k}.txt", b"ab\n" * 2000) for k in range(40)], "source string, content binary")
    files.write_contents(table, path).count()
    pieces, _ = ranges.read_text_pieces(spark, path, range_bytes=1000, split_bytes=4 * (6000 + ranges.OPEN_COST))
    rows = pieces.select("source", "piece_no", F.input_file_name().alias("part")).collect()
    assert len(rows) == 240
    # ten splits, each written by a task: none reads many more ranges than the others
    parts = Counter(r.part for r in rows)
    assert len(parts) >= 8 and max(parts.values()) <= 60
