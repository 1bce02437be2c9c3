import random
import re

import numpy as np
import pytest

from docsheaf.llm import simhash as sh
from docsheaf.llm.components import components


def fingerprint(text, size=3):
    import xxhash

    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(nodes, close):
    """The smallest node that each can reach, by brute force."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if close(a, b) and least[a] < least[b]:
                    least[b], changed = least[a], True
    return least


def test_golay_indices_meet():
    golay, rnd = sh.Golay(), random.Random(1)
    # perfect: every word within three bits of one codeword has its index
    for _ in range(300):
        word = rnd.getrandbits(23)
        index = int(golay.index(np.array([word]))[0])
        assert 0 <= index < 1 << 12
        other = word ^ (1 << rnd.randrange(23)) ^ (1 << rnd.randrange(23))
        near = golay.near(np.array([word, other]), 23)
        assert set(near[0].tolist()) & set(near[1].tolist())
        assert len(set(near[0].tolist())) in (1, 6)


@pytest.mark.parametrize("bucket", [1, 4, 32])
def test_links_of_crowded_fingerprints(spark, bucket):
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    fps = set()
    for _ in range(160):
        fp = rnd.choice(centres)
        for _ in range(rnd.randint(0, 5)):
            fp ^= 1 << rnd.randrange(64)
        fps.add(fp)
    fps = dict(enumerate(sorted(fps)))
    rows = [(n, fp - (1 << 64) if fp >> 63 else fp) for n, fp in fps.items()]
    links = sh.close_links(spark.createDataFrame(rows, "node bigint, fp bigint"), bucket)
    assert all((fps[r.a] ^ fps[r.b]).bit_count() <= 2 for r in links.collect())
    got = {n: n for n in fps} | {r.node: r.component for r in components(links).collect()}
    assert got == linked(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)


def test_documents(table, odd):
    rnd = random.Random(4)
    vocabulary = "the of and A to In is it For on with as by AT from".split()
    base = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60))) for _ in range(25)]
    rows = [(k, rnd.choice(base) + rnd.choice(["", " the", " of"])) for k in range(120)]
    rows += [(200, None), (201, " \n"), (202, "")]
    found = {r.doc_id: r for r in sh.digest(sh.near_duplicates(table(rows))).collect()}
    fps = {doc: fingerprint(text) for doc, text in rows}
    assert {doc: r.fingerprint for doc, r in found.items()} == {doc: f"{fp:016x}" for doc, fp in fps.items()}
    least = linked(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {doc: r.component_id for doc, r in found.items()} == least
    assert sh.near_duplicates(odd).count() == 9


def test_extra_columns_and_empty(odd_extra, empty):
    assert sh.near_duplicates(odd_extra).count() == 9
    assert sh.near_duplicates(empty).collect() == []


def test_components_of_a_long_chain(spark):
    rows = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {501: 500}
